"""Suffix-array dedup: remove every byte covered by a long string that occurs twice.

A string of `length` bytes that starts at two places is a repeat; all bytes it covers go.  Texts are
judged as UTF-8 bytes, on the input, and matches never cross documents.

A sparse suffix array finds the repeats.  Every window of `length` bytes elects one anchor inside it,
the leftmost of its `gram`-byte substrings with the smallest hash.  Equal windows elect the same
anchor, so two equal windows are suffixes that agree from their anchors on and were preceded by the
same bytes.  Consecutive windows with one anchor form a run; a run's context is all its bytes.

1. Every run is named by its anchor's hash and by its context's; anchors that occur once are dropped.
2. Runs whose whole context occurs again are repeats; one of them stands for all.
3. Where an anchor has several contexts, sampled splitters range-partition the contexts as suffixes
   by their leading bytes from the anchor on.  A bucket sorts its suffixes by multikey quicksort, eight
   bytes a character, finds groups that share an anchor, and within a group the windows that occur in
   two contexts.
4. A group at a bucket's border may go on in the next bucket: what its windows leave open is compared
   across boundaries by window hash.  Hot groups thus span many buckets and no task holds one whole.
5. The repeats of a document are merged into spans and cut out.

Counts of equal names are combined before they are shuffled, so thousands of copies meet as one row
per task.  Equality of contexts and of windows is concluded from 128 bits: 64 of their own and 64 of the
anchor.

Defined cases: null and empty texts have no bytes; texts shorter than `length` keep everything; rows that
repeat count as documents of their own, with ids alike or null; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import NO_ID, pieces, row_id, stored, text_bytes, whole_text
from vitrine.llm.sentencepiece_sampling import mixed

LEAD = 24  # bytes of a suffix that choose its bucket; an anchor, if shorter
BUCKET = 10_000  # suffixes in a bucket, about


# --- windows and anchors -------------------------------------------------------------------

def rolling(data: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every substring of `width` bytes, by doubling: one pass per bit of the width."""
    n = len(data) - width + 1
    power, whole = data.astype(np.uint64) + np.uint64(1), None
    size, done, factor, bits = 1, 0, base, width
    while bits:
        if bits & 1:
            part = power[done:done + n]
            whole = part.copy() if whole is None else whole * np.uint64(factor) + part
            done += size
        bits >>= 1
        if bits:
            power = power[:len(power) - size] * np.uint64(factor) + power[size:]
            factor = factor * factor % (1 << 64)
            size *= 2
    return whole


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first and last window, anchor position, anchor hash."""
    hashes = mixed(rolling(data, gram, 0x9E3779B97F4A7C15) ^ np.uint64(0x5851F42D4C957F2D))
    span = length - gram + 1  # grams in a window
    windows = len(data) - length + 1
    # Minimum of each window by blocks: the smallest up to a block's end, and from its start.
    padded = np.full(-(-len(hashes) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(hashes)] = hashes
    grid = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    since = np.minimum.accumulate(grid, axis=1).ravel()
    least = np.minimum(ahead[:windows], since[span - 1:span - 1 + windows])
    # The leftmost gram with a window's minimum: runs of windows with one minimum, then ties by place.
    order = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(order[1:], windows)
    firsts, lasts, places = [], [], []
    candidates = np.flatnonzero((hashes == ahead[:len(hashes)]) | (hashes == since[:len(hashes)]))
    values = hashes[candidates]
    for first, end in zip(order.tolist(), ends.tolist()):
        value = least[first]
        lo, hi = np.searchsorted(candidates, [first, end - 1 + span])
        own = candidates[lo:hi][values[lo:hi] == value]
        w = first
        for p in own.tolist():
            if w >= end:
                break
            if p < w:
                continue
            last = min(p, end - 1)
            firsts.append(w), lasts.append(last), places.append(p)
            w = last + 1
    firsts, lasts, places = (np.array(x, np.int64) for x in (firsts, lasts, places))
    return firsts, lasts, places, hashes[places]


def multikey_quicksort(suffixes: list[bytes]) -> list[int]:
    """Order of the suffixes: partition by the next eight bytes around a pivot, recurse into the equal
    part one character further, into the others at the same one."""
    width = max(map(len, suffixes), default=0) // 8 + 1
    table = np.zeros((len(suffixes), width * 8), np.uint8)
    for i, s in enumerate(suffixes):
        table[i, :len(s)] = np.frombuffer(s, np.uint8)
    keys = table.view(">u8")
    order: list[int] = []
    stack = [(np.arange(len(suffixes)), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= 1 or depth == width:
            order += rows.tolist()
            continue
        k = keys[rows, depth]
        pivot = k[len(k) // 2]
        stack.append((rows[k > pivot], depth))
        stack.append((rows[k == pivot], depth + 1))
        stack.append((rows[k < pivot], depth))
    return order


# --- the steps -----------------------------------------------------------------------------

RUN = "id long, mark long, first int, last int, anchor int, key long, context long"


def all_runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per run: document, first and last window, anchor and its hash, hash of the context."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for doc, mark, text in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "text"))):
                raw = text.encode("utf-8", "replace")
                if len(raw) < length:
                    continue
                first, last, place, key = anchors(np.frombuffer(raw, np.uint8), length, gram)
                # Where the anchor lies is part of what equal contexts share.
                hashed = [xxhash.xxh64_intdigest(raw[f:e + length], seed=p - f)
                          for f, e, p in zip(first.tolist(), last.tolist(), place.tolist())]
                n = len(first)
                for c, v in zip(columns, (np.full(n, doc), np.full(n, mark), first, last, place,
                                          key.view(np.int64), np.array(hashed, np.uint64).view(np.int64))):
                    c.append(v)
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)).cast(k) for c, k in zip(columns, kinds)], names=names)

    return texts.mapInArrow(run, RUN)


def contexts(asked: DataFrame, texts: DataFrame, length: int, lead: int) -> DataFrame:
    """The bytes of the asked runs: suffix from the anchor on, the bytes before it, and its owner."""
    lists = asked.groupBy("id", "mark").agg(
        F.collect_list(F.struct("first", "last", "anchor", "key", "twice")).alias("runs"))
    both = texts.join(lists, ["id", "mark"]).select("id", "mark", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, mark, text, own in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "text", "runs"))):
                raw, n = text.encode("utf-8", "replace"), len(own)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([doc] * n, pa.int64()), "mark": pa.array([mark] * n, pa.int64()),
                    "first": pa.array([r["first"] for r in own], pa.int32()),
                    "key": pa.array([r["key"] for r in own], pa.int64()),
                    "twice": pa.array([r["twice"] for r in own], pa.bool_()),
                    "lead": [raw[r["anchor"]:r["anchor"] + lead] for r in own],
                    "suffix": [raw[r["anchor"]:r["last"] + length] for r in own],
                    "prefix": [raw[r["first"]:r["anchor"]] for r in own]})

    return both.mapInArrow(run, "id long, mark long, first int, key long, twice boolean, lead binary, "
                                "suffix binary, prefix binary")


# What a bucket hands to a part: stretches (id, mark, first, last) and open windows (id, mark, first,
# window, key), each as one table of 64-bit numbers.
FOUND = "part int, stretches binary, windows binary"


def resolved(rows: pd.DataFrame, border: np.ndarray, length: int, parts: int) -> pd.DataFrame:
    """Stretches of windows that occur twice among a bucket's contexts.  Of contexts at the border also
    one of each window, to be compared with other buckets."""
    whole = [p + s for p, s in zip(rows["prefix"], rows["suffix"])]
    sizes = np.array([len(w) for w in whole])
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(whole)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    data = np.frombuffer(b"".join(whole), np.uint8)
    window = mixed(rolling(data, length, 0x9E3779B97F4A7C15))[(np.cumsum(sizes) - sizes)[owner] + place]
    key = rows["key"].to_numpy().view(np.uint64)[owner]
    order = np.argsort(mixed(window + key * np.uint64(0xC2B2AE3D27D4EB4F)), kind="stable")
    w, k = window[order], key[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (k[1:] != k[:-1])])
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new) - 1
    # Runs whose whole context occurs elsewhere count twice by themselves and need no stretch.
    own = rows["twice"].to_numpy(dtype=bool)
    twice = np.bincount(name) > 1
    twice[name[own[owner]]] = True
    ids, marks, starts = (rows[c].to_numpy() for c in ("id", "mark", "first"))
    flag = twice[name] & ~own[owner]
    edge = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    begin = np.flatnonzero(flag & (edge | ~np.concatenate([[False], flag[:-1]])))
    end = np.flatnonzero(flag & ~(np.concatenate([flag[1:], [False]]) & ~np.concatenate([edge[1:], [True]])))
    o = owner[begin]
    stretches = np.stack([ids[o], marks[o], starts[o] + place[begin], starts[o] + place[end]], 1).astype("<i8")
    heads = order[new]
    heads = heads[border[owner[heads]]]
    o = owner[heads]
    open_ = np.stack([ids[o], marks[o], starts[o] + place[heads], window[heads].view(np.int64),
                      key[heads].view(np.int64)], 1).astype("<i8")
    to, at = stretches[:, 0] % parts, (window[heads] % np.uint64(parts)).astype(np.int64)
    used = np.union1d(to, at)
    return pd.DataFrame({"part": used, "stretches": [stretches[to == i].tobytes() for i in used],
                         "windows": [open_[at == i].tobytes() for i in used]})


def sorted_bucket(length: int, parts: int):
    """Sort a bucket's suffixes and resolve its groups."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [b for b in batches if len(b)]
        if not found:
            return
        rows = pd.concat(found, ignore_index=True)
        rows = rows.iloc[multikey_quicksort(list(rows["suffix"]))].reset_index(drop=True)
        # Suffixes with one anchor share its bytes and so are neighbours.  Those that begin like the
        # bucket's first or last may have more of their group in other buckets; others that stand
        # alone have no partner.
        leads = list(rows["lead"])
        border = np.array([lead in (leads[0], leads[-1]) for lead in leads])
        same = np.array([a == b for a, b in zip(leads, leads[1:])], bool)
        near = np.concatenate([same, [False]]) | np.concatenate([[False], same]) | border
        yield resolved(rows[near].reset_index(drop=True), border[near], length, parts)

    return run


def across(group: pd.DataFrame) -> pd.DataFrame:
    """Stretches pass; windows that two buckets have become stretches."""
    done = np.frombuffer(b"".join(group["stretches"]), "<i8").reshape(-1, 4)
    open_ = np.frombuffer(b"".join(group["windows"]), "<i8").reshape(-1, 5)
    order = np.lexsort((open_[:, 4], open_[:, 3]))
    same = (open_[order[1:], 3:] == open_[order[:-1], 3:]).all(1)
    met = np.zeros(len(open_), bool)
    met[order[1:][same]] = met[order[:-1][same]] = True
    more = open_[met][:, [0, 1, 2, 2]]
    return joined(np.concatenate([done, more]))


def joined(stretches: np.ndarray) -> pd.DataFrame:
    """Stretches of one text that touch become one."""
    s = stretches[np.lexsort((stretches[:, 2], stretches[:, 1], stretches[:, 0]))]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:, :2] != s[:-1, :2]).any(1) | (s[1:, 2] > s[:-1, 3] + 1)
    first = np.flatnonzero(new)
    last = np.maximum.reduceat(s[:, 3], first) if len(s) else s[:, 3]
    return pd.DataFrame({"id": s[first, 0], "mark": s[first, 1], "first": s[first, 2], "last": last})


def repeats(named: DataFrame, length: int, gram: int) -> DataFrame:
    """id, mark, first, last: stretches of starts of repeated windows in the texts `named`."""
    rows = stored(all_runs(named, length, gram), "runs")
    keys = rows.groupBy("key").count().where("count > 1").select("key")
    rows = stored(rows.join(keys, "key", "left_semi"), "shared-anchors")
    one = F.min(F.struct("id", "mark", "first", "last", "anchor")).alias("one")
    names = stored(rows.groupBy("key", "context").agg(F.count("*").alias("n"), one), "distinct-contexts")
    several = names.groupBy("key").count().where("count > 1").select("key")
    asked = stored(names.join(several, "key").select("one.*", "key", (F.col("n") > 1).alias("twice")), "asked-contexts")
    whole = rows.join(names.where("n > 1").select("key", "context"), ["key", "context"])
    whole = stored(whole.select("id", "mark", "first", "last"), "whole-contexts")
    count = asked.count()
    parts = pieces(count, 5_000)
    suffixes = contexts(asked, named, length, min(LEAD, gram)).withColumn("salt", F.xxhash64("suffix", "prefix"))
    found = (suffixes.repartitionByRange(pieces(count, BUCKET), "lead", "salt").drop("salt")
             .mapInPandas(sorted_bucket(length, parts), FOUND))
    return found.groupBy("part").applyInPandas(across, "id long, mark long, first int, last int").union(whole)


def remove_repeats(documents: DataFrame, length: int = 400, gram: int = 64) -> DataFrame:
    """id, text without its repeated bytes, and the counts of what was removed, for every row.
    The text comes as bytes, since a cut may fall inside a character."""
    named = documents.select(row_id().alias("id"), F.xxhash64(whole_text()).alias("mark"), whole_text().alias("text"))
    spans = repeats(named, length, gram).groupBy("id", "mark").agg(
        F.collect_set(F.struct("first", "last")).alias("spans")).select(
        F.col("id").alias("i"), F.col("mark").alias("m"), "spans")
    both = named.join(spans, (named["id"] == spans["i"]) & (named["mark"] == spans["m"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode("utf-8", "replace")
                kept, at, pieces_, removed = [], 0, 0, 0
                end = -1  # end of the span under way
                for s in sorted((s["first"], s["last"]) for s in spans or ()):
                    if s[0] > end:
                        if pieces_:
                            at = end
                        kept.append(raw[at:s[0]])
                        pieces_ += 1
                        removed -= s[0]
                        removed += 0 if pieces_ == 1 else end
                    end = max(end, s[1] + length)
                if pieces_:
                    removed += end
                    kept.append(raw[end:])
                data = b"".join(kept) if pieces_ else raw
                for c, v in zip(out, (len(raw), removed, pieces_, data)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.select("id", "text", "spans").mapInArrow(
        run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def deduplicated(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    return remove_repeats(documents).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))
