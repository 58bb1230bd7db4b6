"""LM scoring: a smoothed bigram model as a weighted backoff automaton.

The model of word `v` after `u` is the Dirichlet-smoothed bigram
    P(v|u) = (c(uv) + mu * P(v)) / (c(u) + mu),    P(v) = (c(v) + 0.5) / (N + 0.5 * (V + 1)),
where N and V count the training tokens, and V + 1 leaves room for the unseen word.  Read as an
automaton, every training word is a state, every seen bigram is an arc, and a failure arc of
weight mu / (c(u) + mu) leads to the root, whose arcs carry P(v).  A text is read once from left to
right; the state is the word just read (the root if training never saw it).

No task holds the whole automaton.  Documents are dealt by hash into blocks of bounded size.  A
block sends the sorted keys of its arcs and states with its training counts; the counts of all
blocks are summed by key range; and each block gets back what the others add to its counts, which
completes the part of the automaton that its own texts walk through.  So memory follows the block
size, frequent words meet once per block and no counts are dropped.

Defined cases: null and empty texts are the end token alone; rows that repeat are counted and
scored as often as they occur; a null id is in the fold of the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import NO_ID, fold, pieces, row_id, text_bytes, whole_text

BLOCK_BYTES = 8 << 20
END, START = b"\x00</s>", b"\x00<s>"  # no word holds a zero byte followed by these
MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str) -> list[bytes]:
    # bytes.split() cuts at exactly blank and the bytes 9 to 13; bytes.lower() touches A-Z only.
    return text.encode("utf-8", "surrogatepass").lower().split()


class Block:
    """Tokens of a block's documents as 64-bit word hashes, with its distinct states and arcs."""

    def __init__(self, texts: list[str], training: np.ndarray) -> None:
        known: dict[bytes, int] = {START: 0, END: 1}
        flat, lengths = [], []
        for text in texts:
            ids = [known.setdefault(w, len(known)) for w in _words(text)]
            ids.append(1)
            lengths.append(len(ids))
            flat.append(np.array(ids, np.int32))
        self.lengths = np.array(lengths, np.int64)
        tokens = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        first = np.zeros(len(tokens), bool)
        first[np.cumsum(self.lengths) - self.lengths] = len(tokens) > 0
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first] = 0
        train = np.repeat(training, self.lengths)
        # States are distinct word hashes; arcs hash the pair of words.
        self.states, where = np.unique(hashes, return_inverse=True)
        self.token, self.before = where[tokens], where[before]
        pair = arc_key(hashes[before], hashes[tokens])
        self.arcs, self.arc = np.unique(pair, return_inverse=True)
        self.state_counts = np.bincount(self.token[train], minlength=len(self.states))
        self.start = int(where[0])
        self.state_counts[self.start] = int(training.sum())
        self.arc_counts = np.bincount(self.arc[train], minlength=len(self.arcs))


def arc_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    x = (before * MIX) ^ (token + (before << np.uint64(23)) + (before >> np.uint64(41)))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart: their zero planes compress away."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def split_keys(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of `parts` equal key ranges in sorted keys."""
    edges = [np.uint64((i << 64) // parts) for i in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(int)


def _counted(blocks: DataFrame, parts: int, kinds: tuple[str, ...]) -> DataFrame:
    """Rows (block, kind, part, keys, counts): each block's distinct keys with its training counts."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        b = Block(list(group["text"]), group["train"].to_numpy(dtype=bool))
        rows = []
        for kind, keys, counts in (("state", b.states, b.state_counts), ("arc", b.arcs, b.arc_counts)):
            if kind not in kinds:
                continue
            cut = split_keys(keys, parts)
            for i in range(parts):
                lo, hi = cut[i], cut[i + 1]
                if hi > lo:
                    rows.append((int(group["block"].iloc[0]), kind, i, pack(keys[lo:hi]),
                                 pack_counts(counts[lo:hi])))
        return pd.DataFrame(rows, columns=["block", "kind", "part", "keys", "counts"])

    return blocks.groupBy("block").applyInPandas(
        run, "block long, kind string, part int, keys binary, counts binary")


def _sums(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    keys = [unpack(k) for k in group["keys"]]
    counts = [unpack_counts(c) for c in group["counts"]]
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)
    return every, total, keys, counts


def _answers(counted: DataFrame) -> DataFrame:
    """For each block and key range what the other blocks add to its counts, in the order of its keys."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        every, total, keys, counts = _sums(group)
        more = [pack_counts(total[np.searchsorted(every, k)] - c) for k, c in zip(keys, counts)]
        return pd.DataFrame({"block": group["block"], "kind": group["kind"], "part": group["part"], "counts": more})

    return counted.groupBy("kind", "part").applyInPandas(run, "block long, kind string, part int, counts binary")


def _training_words(documents: DataFrame, size: int) -> tuple[int, int]:
    """N and V of the training texts: tokens, and distinct tokens with the end token."""
    parts = pieces(size, 64 << 20)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[bytes] = {END}
            n = 0
            for text in batch.column("text").to_pylist():
                ws = _words(text)
                n += len(ws) + 1
                found.update(ws)
            keys = np.unique(np.fromiter((xxhash.xxh64_intdigest(w) for w in found), np.uint64, len(found)))
            cut = split_keys(keys, parts)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(range(parts), pa.int32()), "n": [n] + [0] * (parts - 1),
                 "keys": [pack(keys[cut[i]:cut[i + 1]]) for i in range(parts)]})

    def distinct(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.concatenate([unpack(k) for k in group["keys"]]))
        return pd.DataFrame({"n": [int(group["n"].sum())], "v": [len(keys)]})

    found = (documents.where("train").select("text").mapInArrow(local, "part int, n long, keys binary")
             .groupBy("part").applyInPandas(distinct, "n long, v long")
             .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first())
    return found["n"] or 0, found["v"] or 0


def score(documents: DataFrame, folds: int = 5, left_out: int = 1, mu: float = 8.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document,
    learnt from the documents outside the fold `left_out`.  Scores are log10 probabilities."""
    size = text_bytes(documents)
    rows = documents.select(row_id().alias("doc_id"), whole_text().alias("text"),
                            (fold("doc_id", folds) != left_out).alias("train"))
    total, distinct = _training_words(rows, size)
    norm = total + 0.5 * (distinct + 1)
    blocks = pieces(size, BLOCK_BYTES)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)))
    dealt = dealt.select("block", "doc_id", "text", "train")
    answers = _answers(_counted(dealt, pieces(size, 16 << 20), ("state", "arc")))

    def corrected(own: np.ndarray, got: pd.DataFrame, kind: str) -> np.ndarray:
        ranges = got[got["kind"] == kind].sort_values("part")["counts"]
        return own + np.concatenate([unpack_counts(c) for c in ranges]).astype(np.float64)

    def walk(group: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame(columns=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])
        b = Block(list(group["text"]), group["train"].to_numpy(dtype=bool))
        seen = corrected(b.state_counts, got, "state")
        arcs = corrected(b.arc_counts, got, "arc")
        root = (seen + 0.5) / norm  # arcs of the root, by word
        fail = mu / (seen + mu)  # failure arcs, by state
        # The state before each token, then its arc if training saw the pair, else failure and root.
        state, token, arc = b.before, b.token, arcs[b.arc]
        taken = np.where(arc > 0, (arc + mu * root[token]) / (seen[state] + mu), fail[state] * root[token])
        at = np.cumsum(b.lengths) - b.lengths
        return pd.DataFrame({
            "doc_id": group["doc_id"], "train": group["train"], "n_tokens": b.lengths,
            "n_known": np.add.reduceat((seen[token] > 0).astype(np.int64), at),
            "base_score": np.add.reduceat(np.log10(root[token]), at),
            "score": np.add.reduceat(np.log10(taken), at)})

    walked = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        walk, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return walked.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
