"""Line dedup: near-equal lines of a corpus by MinHash, in DataFrame functions only.

Lines are what line feeds separate.  Equal lines meet by hash.  Unlike ones are compared as sets of
`shingle`-character substrings; a shorter line is one shingle.  A one-permutation MinHash deals the
shingle hashes into bins and keeps the smallest of each: `bands` groups of `rows_` bins.  Lines that
agree in a whole band are candidates: at a similarity of 0.8 a pair meets with 98.6 %, at 0.9
with 99.98 %.  Candidates whose sizes and parities of shingles allow a link (a bound that never drops
one) are verified by the exact Jaccard similarity of their shingle sets, a distributed union-find joins what is linked (`linking`, `common.components`), and of each component only
the first line of the smallest document stays.

Cost: signatures are made inside generated code from the shingles of a line's UTF-8 bytes, which are
cut out in constant time, so a line of any length takes linear time; verification counts characters.
Of a long line mostly shingles with small hashes are a bin's minimum; the others are dropped before
the aggregation (a bin of unlike shingles goes empty by that with e**-8).  Lines with an empty bin, as long
lines that repeat themselves have, are done again with every shingle, so the minima are those of all.
What is shuffled per distinct line is its signature; line texts move only for candidates and, where
they are too many to broadcast their names, for lines done again.  A line found in a third of all
documents is counted within each task first.

Defined cases: blank lines are never compared or removed; null and empty texts have no lines and
stay; rows alike in id and text are one document; a document whose lines are all removed is gone
in `without_repeats`; lines are named by 64-bit hashes; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import NO_ID, row_id, stored
from vitrine.llm.linking import link_groups
from vitrine.llm.ngram_join import PARITY_WORDS, may_link


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(row_id().alias("id"), F.xxhash64("text").alias("mark"), "text")


def _lines(documents: DataFrame) -> DataFrame:
    """id, mark, pos, line and its name of every line that is not blank."""
    return (_documents(documents).select("id", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .where(F.col("line").rlike(r"\S")).withColumn("name", F.xxhash64("line")))


def _minima(lines: DataFrame, shingle: int, bins: int, dense: float | None) -> DataFrame:
    """name, size and the bin minima of every distinct line; with `dense` only minima so small that a
    line of unlike shingles has about that many in a bin, the others stay null."""
    # Bytes are cut out at a known place, characters would be counted from the line's start.
    raw = lines.select("name", F.col("line").cast("binary").alias("raw"), F.octet_length("line").alias("size"))
    places = F.sequence(F.lit(1), F.greatest(F.col("size") - (shingle - 1), F.lit(1)))
    hashed = raw.select("name", "size", "raw", F.explode(places).alias("at")).select(
        "name", "size", "at", F.xxhash64(F.substring(F.col("raw"), F.col("at"), F.lit(shingle))).alias("h"))
    value = F.shiftrightunsigned("h", 33).cast("int")  # 31 bits
    dealt = hashed.select("name", "size", "at", F.pmod(F.col("h"), F.lit(bins)).cast("int").alias("bin"), value.alias("v"))
    if dense is not None:
        small = F.col("v") < F.lit(dense * bins * (1 << 31)) / F.col("size")
        # The first shingle stays as a row, so that no line vanishes.
        dealt = dealt.where(small | (F.col("at") == 1)).withColumn("v", F.when(small, F.col("v")))
    return dealt.groupBy("name").agg(F.max("size").alias("size"), *[
        F.min(F.when(F.col("bin") == i, F.col("v"))).alias(f"b{i}") for i in range(bins)])


def signatures(lines: DataFrame, shingle: int, bands: int, rows_: int, dense: float = 8.0) -> DataFrame:
    """name and the bin minima b0, b1, ... of every distinct line, over all its shingles."""
    bins = bands * rows_
    names = ["name", *(f"b{i}" for i in range(bins))]
    first = stored(_minima(lines, shingle, bins, dense), "line-minima")
    # A bin that is empty may have lost its shingles to the limit: such lines are done again without one.
    limited = F.col("size") >= int(dense * bins)
    again = limited & F.array_contains(F.array(*[F.col(n).isNull() for n in names[1:]]), True)
    open_ = stored(first.where(again).select("name"), "open-lines")
    long_ = lines.where(F.octet_length("line") >= int(dense * bins)).join(open_, "name", "left_semi")
    return first.where(~again).select(*names).union(_minima(long_, shingle, bins, None).select(*names))


def band_members(signed: DataFrame, bands: int, rows_: int) -> DataFrame:
    """(sig, node) of bands that are not empty."""
    made = []
    for b in range(bands):
        own = [F.col(f"b{b * rows_ + r}") for r in range(rows_)]
        some = F.coalesce(*own).isNotNull()
        made.append(F.when(some, F.xxhash64(F.lit(b), *[F.coalesce(c, F.lit(-1)) for c in own])))
    exploded = signed.select(F.col("name").alias("node"), F.explode(F.array(*made)).alias("sig"))
    return exploded.where("sig is not null").select("sig", "node")


def shared_bands(members: DataFrame) -> DataFrame:
    """(sig, node) of the bands that two or more lines have."""
    return (members.withColumn("n", F.count("*").over(Window.partitionBy("sig")))
            .where("n > 1").select("sig", "node"))


def shingles(line: str, shingle: int) -> Column:
    # Four bytes a character, so that a shingle is cut out in constant time; an array of one holds them, because
    # what stands inside a lambda itself is made again for every place.
    places = F.sequence(F.lit(1), F.length(line) * 4 - (4 * shingle - 1), F.lit(4))
    hashes = F.transform(F.array(F.encode(F.col(line), "UTF-32")), lambda raw: F.transform(
        places, lambda i: F.xxhash64(F.substring(raw, i, F.lit(4 * shingle)))))
    return F.when(F.length(line) < shingle, F.array(F.xxhash64(F.col(line)))).otherwise(F.array_distinct(hashes[0]))


def sketched(texts: DataFrame, shingle: int) -> DataFrame:
    """node, size (number of distinct shingles) and their parities, see `ngram_join.parities`, of every line."""
    hashed = texts.select(F.col("name").alias("node"), F.explode(shingles("line", shingle)).alias("h"))
    word = F.shiftright("h", 6).bitwiseAND(F.lit(PARITY_WORDS - 1))
    return hashed.select("node", word.alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("v")).groupBy("node").agg(
        F.count("*").alias("size"), F.array(*[F.coalesce(F.bit_xor(F.when(F.col("w") == i, F.col("v"))), F.lit(0).cast("long"))
                                              for i in range(PARITY_WORDS)]).alias("bits"))


def candidate_lines(names: DataFrame, documents: DataFrame, firsts: DataFrame) -> DataFrame:
    """name and line of the given names.  Each line's text is taken from its first occurrence."""
    wanted = (names.join(firsts, "name").groupBy("first.id", "first.mark")
              .agg(F.collect_list(F.struct("first.pos", "name")).alias("places")))
    # The generator keeps the split from being repeated for every place.
    return (_documents(documents).join(wanted, ["id", "mark"])
            .select("places", F.explode(F.array(F.split("text", "\n"))).alias("lines"))
            .select("lines", F.explode("places").alias("p"))
            .select(F.col("p.name").alias("name"), F.element_at("lines", F.col("p.pos") + 1).alias("line"))
            .dropDuplicates(["name"]))


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs of line names whose shingle sets reach the threshold."""
    # The shingles of a line are made once for a chunk of its partners.
    chunks = F.ceil(F.count("*").over(Window.partitionBy("a")) / 50)
    cut = pairs.withColumn("part", F.pmod(F.xxhash64("b"), chunks))
    others = (cut.join(texts.select(F.col("name").alias("b"), F.col("line").alias("y")), "b")
              .groupBy("a", "part").agg(F.collect_list(F.struct("b", "y")).alias("others")))
    # Only the texts of pairs are moved.
    base = texts.select(F.col("name").alias("a"), F.col("line").alias("x")).join(
        pairs.select("a").distinct(), "a", "left_semi")
    one = others.join(base, "a")
    one = one.select("a", F.explode(F.array(shingles("x", shingle))).alias("x"), "others")
    two = one.select("a", "x", F.explode("others").alias("o")).select(
        "a", "x", "o.b", F.explode(F.array(shingles("o.y", shingle))).alias("y"))
    both = two.select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"),
                      (F.size("x") + F.size("y")).alias("total"))
    return both.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("a", "b")


def repeated_lines(documents: DataFrame, shingle: int = 8, percent: int = 80, bands: int = 6,
                   rows_: int = 3) -> DataFrame:
    """id, mark and the sorted places `removed` of the lines that go, for documents that lose any."""
    lines = _lines(documents)
    occurrences = stored(lines.select("id", "mark", "pos", "name"), "line-names")
    firsts = stored(occurrences.groupBy("name").agg(F.min(F.struct("id", "mark", "pos")).alias("first"),
                                                    F.count("*").alias("n")), "line-firsts")
    members = stored(shared_bands(band_members(signatures(lines, shingle, bands, rows_), bands, rows_)), "shared-bands")
    # The texts of candidates are fetched once for all rounds of verification.
    names = members.select(F.col("node").alias("name")).distinct()
    texts = stored(candidate_lines(names, documents, firsts), "candidate-lines")
    sketches = stored(sketched(texts, shingle), "line-sketches")

    def near(s: str, t: str) -> Column:
        return F.least(s, t) * 100 >= F.greatest(s, t) * percent

    def apart(x: str, y: str, s: str, t: str) -> Column:
        return may_link(x, y, s, t, percent)

    component, _ = link_groups(members, lambda pairs: verified(pairs, texts, shingle, percent), "line-links",
                               sketches.select("node", "size"), near, sketches.select("node", "bits"), apart, rounds=1)
    grouped = (firsts.join(component.withColumnRenamed("node", "name"), "name", "left")
               .withColumn("component", F.coalesce("component", "name")))
    several = (grouped.where((F.col("n") > 1) | (F.col("component") != F.col("name")))
               .select("component").distinct())
    grouped = grouped.join(several, "component", "left_semi")
    keep = grouped.groupBy("component").agg(F.min("first").alias("keep"))
    doomed = grouped.join(keep, "component").select("name", "keep")
    gone = (occurrences.join(doomed, "name")
            .where(F.struct("id", "mark", "pos") != F.col("keep")).select("id", "mark", "pos"))
    return gone.groupBy("id", "mark").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def line_counts(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the places (from 0) of the removed lines of every document."""
    gone = repeated_lines(documents).select(F.col("id").alias("i"), F.col("mark").alias("m"), "removed")
    n = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    rows = _documents(documents).select("id", "mark", F.when(F.col("text").isNull(), 0).otherwise(n).alias("n_lines"))
    both = rows.join(gone, (F.col("id") == F.col("i")) & (F.col("mark") == F.col("m")), "left")
    none = F.array().cast("array<int>")
    return both.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_lines",
                       F.size(F.coalesce("removed", none)).alias("n_removed"),
                       F.coalesce("removed", none).alias("removed"))


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents without their removed lines, with their own columns; `n_chars`, where present,
    follows the text.  Documents that lose every line but blank ones are gone."""
    names = documents.columns
    gone = repeated_lines(documents).select(F.col("id").alias("__i"), F.col("mark").alias("__m"), "removed")
    marked = documents.withColumns({"__id": row_id(), "__mark": F.xxhash64("text")})
    both = marked.join(gone, (F.col("__id") == F.col("__i")) & (F.col("__mark") == F.col("__m")), "left")
    # The generator keeps the split from being repeated for every line.
    split = both.withColumn("__lines", F.explode(F.array(F.when(
        F.col("removed").isNotNull(), F.split("text", "\n")).otherwise(F.array("text")))))
    kept = F.array_except(F.sequence(F.lit(1), F.size("__lines")), F.transform("removed", lambda p: p + 1))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda p: F.element_at("__lines", p)), "\n"))
    out = split.withColumn("__text", F.explode(F.array(text))).where(
        F.col("removed").isNull() | F.col("__text").rlike(r"\S"))
    new = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in names])
