"""N-gram Jaccard join by universe partitioning.

A document's set holds its distinct word shingles as 64-bit hashes.  Two sets of sizes a <= c with
Jaccard similarity >= t differ in at most a * (1 - t) / t elements.  Documents are dealt into size
bands; in a band whose smaller set has up to `hi` elements a pair differs in at most
H = hi * (1 - t) / t, and a hash cuts the universe of shingles into segments.  By the pigeonhole
principle a pair agrees up to v_i differences in some segment i whenever the allocation has
sum(v_i + 1) >= H + 1, where v_i = -1 skips a segment, 0 posts its subset and 1 posts the subset and
all its one-deletion neighbours.  The allocation of a band is the cheapest by a cost of postings and
expected chance matches; it depends on the counts of all sets.

Subsets without elements agree in all sets that leave the same segment empty, so they are posted last: of
the segments for E exact subsets there are a few more than E, and a set posts the first E of those that
it fills, followed by empty ones only where it fills fewer.  If at most E - 1 of these segments
differ, two sets still meet.  Where both fill E, take the one whose posted segments end first: one of
them agrees, and the other one posts it too.  Where only one fills fewer, it posts all it fills, and a posted
segment of the other that agrees is among them.  Where both fill fewer and none that they fill agrees, the at
most E - 1 segments that either fills all differ, and the first segment beyond them is posted by both.

Equal sets are merged first.  Postings are reduced before they are shuffled: a batch names the smallest
set of each signature, packed in sorted runs, and keeps its other members beside it.  Components
come from `linking`, whose candidates are verified exactly on the whole texts' shingles.  Of large groups only
pairs whose parities allow a link become candidates: a bound that never drops a link, see `parities`.

Defined cases: texts that are null or without words have an empty set and link with nothing; texts
with fewer than `n` words are one shingle; rows are documents of their own, with ids alike or null: what
is linked are sets, named by 64-bit hashes, and ids only label components (null only where no member
has an id; an id repeated with unlike texts may label several); other columns play no part; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import NO_ID, map_texts, pieces, row_id, stored, text_bytes
from vitrine.llm.linking import link_groups
from vitrine.llm.lm_score import pack, split_keys, unpack
from vitrine.llm.sentencepiece_sampling import mixed

PARITY_WORDS = 8  # words of 64 bits
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Shingler:
    """Distinct word shingles of whole texts as sorted 64-bit hashes."""

    def __init__(self, n: int, cache: int = 500_000) -> None:
        self.n, self.cache = n, cache
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.cache:
            self.known.clear()
        known, words = self.known, text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        x = h[:len(h) - n + 1].copy()
        for i in range(1, n):
            x = mixed(x * C1 + h[i:len(h) - n + 1 + i])
        return np.unique(x if n == self.n else x + np.uint64(int(C2) * n & 0xFFFFFFFFFFFFFFFF))


# --- bands and allocation ------------------------------------------------------------------

def band_starts(largest: int, percent: int, ratio: float = 1.25) -> list[int]:
    """First sizes of the bands: a set and a partner at the threshold are at most one band apart."""
    starts = [1]
    while starts[-1] <= largest:
        low = starts[-1]
        starts.append(max(int(low * ratio), (low * 100) // percent) + 1)
    return starts


def allocate(size: int, differ: int, sets: int, share: float = 0.02) -> tuple[int, int, int]:
    """(segments, exactly posted, posted with deletions) of least cost for sets of about `size`
    elements that differ in at most `differ`; the other segments are skipped.  A posting costs one;
    an exact subset of q elements meets each of the other sets by chance with share ** q."""
    best, cost = (differ + 1, differ + 1, 0), float("inf")
    need = differ + 1
    for loose in sorted({0, need // 4, need // 2, (need + 1) // 2}):
        exact = max(0, need - 2 * loose)
        for skipped in sorted({0, need // 16}):
            m = exact + loose + skipped
            q = size / m
            now = exact * (1 + sets * share ** q) + loose * (1 + q) * (1 + sets * share ** max(0.0, q - 1))
            if now < cost:
                best, cost = (m, exact, loose), now
    return best


def spread(size: int, m: int, exact: int) -> int:
    """How many segments to add to `m`, so that with those a set of `size` elements fills `exact` of the
    exactly posted ones, by two standard deviations."""
    more = 0
    while exact and more < 3 * exact + 8:
        zone, n = exact + more, m + more
        one, two = (1 - 1 / n) ** size, max(0.0, 1 - 2 / n) ** size  # that a segment is empty, that two are
        varies = zone * one * (1 - one) + zone * (zone - 1) * (two - one * one)
        if zone * (1 - one) >= exact + 2 * max(varies, 0.0) ** 0.5:
            break
        more += max(1, exact // 64)
    return more


class Bands:
    def __init__(self, counts: dict[int, int], largest: int, percent: int) -> None:
        """`counts`: number of sets by size, which only steers the cost; `largest`: the largest size."""
        self.percent = percent
        self.starts = np.array(band_starts(largest, percent))
        per = np.zeros(len(self.starts) + 1, np.int64)
        for size, n in counts.items():
            per[self.of(size)] += n
        self.plan = []
        for b in range(len(self.starts)):
            hi = int(self.starts[b + 1]) - 1 if b + 1 < len(self.starts) else int(self.starts[b])
            low = int(self.starts[b])
            m, exact, loose = allocate(low, hi * (100 - percent) // percent, int(per[b] + per[b + 1]))
            more = spread(low, m, exact)
            self.plan.append((m + more, exact + more, exact, loose))

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """Postings of a set in its own band, and in the one below if a smaller partner may lie there."""
        size = len(shingles)
        own = self.of(size)
        least = -(-size * self.percent // 100)
        out = [self._postings(shingles, own)]
        if own and least < self.starts[own]:
            out.append(self._postings(shingles, own - 1))
        return np.concatenate(out)

    def _postings(self, shingles: np.ndarray, band: int) -> np.ndarray:
        m, zone, exact, loose = self.plan[band]
        segment = (mixed(shingles ^ C3) % np.uint64(m)).astype(np.int64)
        value = mixed(shingles + C2)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, segment, value)
        name = mixed(np.arange(zone + loose, dtype=np.uint64) * C1
                     + np.uint64(band * int(C2) + int(C3) & 0xFFFFFFFFFFFFFFFF))
        empty = np.bincount(segment, minlength=m)[:zone] == 0
        used = np.argsort(empty, kind="stable")[:exact]
        used = np.concatenate([used, np.arange(zone, zone + loose)])
        out = [mixed(sums[used] ^ name[used])]
        if loose:
            of = np.flatnonzero((segment >= zone) & (segment < zone + loose))
            out.append(mixed((sums[segment[of]] - value[of]) ^ name[segment[of]]))
        return np.concatenate(out)


# --- the join ------------------------------------------------------------------------------

def set_name(shingles: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    return (xxhash.xxh3_128_intdigest(shingles.tobytes()) & (1 << 64) - 1) - (1 << 63)


def _marked(documents: DataFrame) -> DataFrame:
    """id, a 64-bit mark of the row's columns, and text: what tells rows apart."""
    others = [c for c in documents.columns if c != "text"]
    return documents.select(row_id().alias("id"), F.xxhash64("text", F.to_json(F.struct(*others))).alias("mark"), "text")


def parities(shingles: np.ndarray) -> list[int]:
    """Bit i of these words: whether an odd number of the set's shingles falls to place i.  Each shingle that
    only one of two sets has turns one bit, so sets differ in at least as many shingles as they do in bits."""
    counts = np.bincount((mixed(shingles + C3) % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8").tolist()


def may_link(x: str, y: str, s: str, t: str, percent: int) -> F.Column:
    """False only where parities x and y tell that sets of sizes s and t are below the threshold."""
    differ = sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(1, PARITY_WORDS)),
                 F.bit_count(F.col(x)[0].bitwiseXOR(F.col(y)[0])))
    return differ * (100 + percent) <= (F.col(s) + F.col(t)) * (100 - percent)


def described(marked: DataFrame, n: int) -> DataFrame:
    """id, mark, set size, the set's name and its parities."""
    def run(texts: list) -> list[list]:
        shingler = Shingler(n)
        sizes, names, bits = [], [], []
        for t in texts:
            s = shingler(t)
            sizes.append(len(s))
            names.append(set_name(s))
            bits.append(parities(s))
        return [sizes, names, bits]

    return map_texts(marked, "text", "size long, node long, bits array<bigint>", run)


def posted(documents: DataFrame, bands: Bands, n: int, parts: int) -> DataFrame:
    """(sig, node) of all signatures that two or more different sets share."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for number, batch in enumerate(batches):
            sets: dict[int, np.ndarray] = {}
            for text in batch.column("text").to_pylist():
                s = shingler(text)
                if len(s) and (key := set_name(s)) not in sets:
                    sets[key] = bands.signatures(s)
            if not sets:
                continue
            sigs = np.concatenate(list(sets.values()))
            docs = np.repeat(np.array(list(sets), np.int64), [len(v) for v in sets.values()])
            order = np.lexsort((docs, sigs))
            sigs, docs = sigs[order], docs[order]
            first = np.concatenate([[True], sigs[1:] != sigs[:-1]])
            heads, names = sigs[first], docs[first]
            cut = split_keys(heads, parts)
            rows = [(0, i, pack(heads[cut[i]:cut[i + 1]]), names[cut[i]:cut[i + 1]].tobytes())
                    for i in range(parts) if cut[i + 1] > cut[i]]
            # All members of what this batch itself has twice, spread by no signature.
            many = np.repeat(np.diff(np.append(np.flatnonzero(first), len(sigs))) > 1, np.diff(
                np.append(np.flatnonzero(first), len(sigs))))
            if many.any():
                spread = int(heads[0] >> np.uint64(20)) % parts
                rows.append((1, spread, pack(sigs[many]), docs[many].tobytes()))
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([r[0] for r in rows], pa.int32()), "part": pa.array([r[1] for r in rows], pa.int32()),
                "sigs": [r[2] for r in rows], "docs": [r[3] for r in rows]})

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        sigs = np.concatenate([unpack(s) for s in group["sigs"]])
        docs = np.concatenate([np.frombuffer(d, np.int64) for d in group["docs"]])
        if int(group["kind"].iloc[0]) == 0:
            order = np.lexsort((docs, sigs))
            sigs, docs = sigs[order], docs[order]
            new = np.concatenate([[True], (sigs[1:] != sigs[:-1]) | (docs[1:] != docs[:-1])])
            sigs, docs = sigs[new], docs[new]  # batches may name the same set
            same = sigs[1:] == sigs[:-1]
            keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            sigs, docs = sigs[keep], docs[keep]
        return pd.DataFrame({"sig": sigs.view(np.int64), "node": docs})

    packed = documents.select("text").mapInArrow(
        local, "kind int, part int, sigs binary, docs binary")
    return packed.groupBy("kind", "part").applyInPandas(gather, "sig long, node long")


def verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int, chunk: int = 200) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the threshold.  A document with many partners is
    compared in chunks of them."""
    size = pairs.groupBy("a").agg(F.ceil(F.count("*") / chunk).alias("chunks"))
    cut = pairs.join(size, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("chunks")))
    other = cut.join(texts.select(F.col("node").alias("b"), "text"), "b").select(
        F.col("a").alias("h"), F.col("part").alias("q"), "b", F.col("text").alias("other"))
    one = (cut.select("a", "part").distinct()
           .join(texts.select(F.col("node").alias("a"), "text"), "a").select(F.col("a").alias("one"), F.col("part").alias("p"), F.col("text").alias("base")))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        shingler = Shingler(n)
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []})
        base, out = shingler(left["base"].iloc[0]), []
        for b, text in zip(right["b"], right["other"]):
            s = shingler(text)
            common = len(np.intersect1d(base, s, assume_unique=True))
            if common and 100 * common >= percent * (len(base) + len(s) - common):
                out.append(b)
        return pd.DataFrame({"a": left["one"].iloc[0], "b": out})

    return one.groupBy("one", "p").cogroup(other.groupBy("h", "q")).applyInPandas(compare, "a long, b long")


def linked(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """id, mark, size and node (the set) of every row; node, group (the component of sets) and first, the
    (is null, id, mark) of the smallest row, of every set that is not empty."""
    size = text_bytes(documents)
    marked = _marked(documents)
    rows = stored(described(marked, n), "shingle-sets")
    smallest = F.min(F.struct((F.col("id") == NO_ID).alias("none"), "id", "mark"))
    sets = stored(rows.where("size > 0").groupBy("node").agg(
        F.max("size").alias("size"), smallest.alias("first"), F.first("bits").alias("bits")), "distinct-sets")
    counts = {r["size"]: r["count"] for r in _size_classes(sets)}
    bands = Bands(counts, sets.agg(F.max("size")).first()[0] or 1, percent)
    members = stored(posted(documents, bands, n, pieces(size, 16 << 20)).distinct(), "signatures")
    # The texts of candidates are fetched once for all rounds of verification.
    wanted = members.select("node").distinct().join(sets, "node").select("node", "first.id", "first.mark")
    texts = stored(marked.join(wanted, ["id", "mark"]).select("node", "text").dropDuplicates(["node"]),
                   "candidate-texts")

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(pairs, texts, n, percent)

    def near(s: str, t: str) -> F.Column:
        return F.least(s, t) * 100 >= F.greatest(s, t) * percent

    def apart(x: str, y: str, s: str, t: str) -> F.Column:
        return may_link(x, y, s, t, percent)

    component, _ = link_groups(members, verify, "ngram-links", sets.select("node", "size"), near,
                               sets.select("node", "bits"), apart)
    grouped = sets.join(component, "node", "left").select(
        "node", F.coalesce("component", "node").alias("group"), "first")
    return rows, stored(grouped, "ngram-groups")


def join(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """id, size and component of every row; a component is its smallest id."""
    rows, sets = linked(documents, n, percent)
    labels = sets.groupBy("group").agg(F.min("first").alias("label")).select("group", "label.id")
    labels = sets.select("node", "group").join(labels, "group").select("node", F.col("id").alias("component"))
    return rows.join(labels, "node", "left").select(
        "id", "size", F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def _size_classes(sets: DataFrame) -> list:
    """Number of sets by size to three digits: some hundred rows per power of ten."""
    step = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10("size")) - 2, F.lit(0)))
    return sets.groupBy((F.floor(F.col("size") / step) * step).cast("long").alias("size")).count().collect()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return join(documents).select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
                                  F.col("size").alias("n_shingles"),
                                  F.nullif("component", F.lit(NO_ID)).alias("component_id"))


def one_of_each(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Of every group the document with the smallest id, and every document without words, with its
    own columns."""
    names = documents.columns
    rows, sets = linked(documents, n, percent)
    kept = sets.groupBy("group").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias("__id"), F.col("first.mark").alias("__mark"), F.lit(True).alias("__one"))
    empty = rows.where("size = 0").select(
        F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.lit(False).alias("__one")).distinct()
    others = [c for c in names if c != "text"]
    marked = documents.withColumns({"__id": row_id(), "__mark": F.xxhash64("text", F.to_json(F.struct(*others)))})
    both = marked.join(kept.union(empty), ["__id", "__mark"])
    # Rows with one id and mark are alike in all columns.
    return (both.where("__one").dropDuplicates(["__id", "__mark"]).select(*names)
            .union(both.where("not __one").select(*names)))
