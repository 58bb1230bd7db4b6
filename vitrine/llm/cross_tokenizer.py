"""Alignment of two tokenizers' tokens by merge path.

Both tokenizers cut the same bytes, so a text's tokens are two ascending lists of end offsets.  Merging
them (of equal ends the A end first) walks a path through the grid of A and B tokens.  Every step's link
follows from where it stands: consuming an A token, that token overlaps the current B token, and
consuming a B token it overlaps the current A token, unless the A token before ends at the same byte,
which closes a group.  Diagonals at equal distances cut the path: a binary search on each finds how many
ends of either list lie before it, and the pieces between two diagonals hold equal numbers of steps and
need nothing from each other.  All pieces of a slice of texts advance together, one step of each at a
time, so one long text is as many pieces as many short ones.  A group that a diagonal cuts is stitched by
numbering the closed groups of all pieces in order.

Encoding takes each distinct unit of a slice through both vocabularies once.  A unit ends before a blank or
line break that follows other text; no A token crosses that, and no B token either unless the model has
a piece with such a place inside, which is looked up.  Units whose bytes are not those of their text
send their whole texts through the libraries.

Counts of id pairs cover the corpus.  A chunk (a task's texts up to a bound) sends each of its distinct
pairs once with its count; totals and the highest total of each B id come back to the chunks that hold the
pair, where texts keep their links as numbers of the chunk's pairs.  Pairs are never gathered whole, and
what a task holds is bounded by the chunk.

Defined cases: null and empty texts, and texts that either tokenizer does not give back byte for byte
(the B model's own blank sign in a text), have no tokens, zeros and an empty `groups_sha256`; strings of
special tokens in texts are plain text; rows with one id are rows of their own, also where equal; an
empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import stored, whole_text
from vitrine.llm.wavelet import visible_bytes

# Python and the A library see other white space alike, but not these separators.
ODD = re.compile("[\x1c-\x1f]")
UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
# Fixed value: the byte-level pattern of the library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "\u2581"  # stands for a blank in B's pieces
ROW = 2000  # units encoded at once
WORK = 64  # steps of a piece


# --- merge path ------------------------------------------------------------------------------

def diagonal(a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """How many of the ends `a` lie within the first `steps` steps of the merge with `b`, for each of
    `steps`: the smallest i whose a[i] comes after b[steps - i - 1]."""
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        after = b[steps[open_] - 1 - middle] < a[middle]
        high[open_[after]] = middle[after]
        low[open_[~after]] = middle[~after] + 1


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Walk the merge of two ascending lists of ends: per step the A and the B token it stands on, and
    whether it closes a group (then it links nothing)."""
    n = len(a) + len(b)
    starts = np.arange(0, n, work, dtype=np.int64)
    i = diagonal(a, b, starts).astype(np.int32)
    j = (starts - i).astype(np.int32)
    last = np.iinfo(np.int64).max
    a, b = np.append(a, last), np.append(b, last)
    before = np.concatenate([[-1], a[:-1]])  # the A end before a token
    at_a, at_b = np.empty((work, len(starts)), np.int32), np.empty((work, len(starts)), np.int32)
    closes = np.empty((work, len(starts)), bool)
    for step in range(work):  # the steps beyond the end stand on the sentinels
        end = b[j]
        take = a[i] <= end
        at_a[step], at_b[step] = i, j
        closes[step] = ~take & (before[i] == end)
        i = np.minimum(i + take, len(a) - 1)
        j = np.minimum(j + ~take, len(b) - 1)
    return at_a.T.ravel()[:n], at_b.T.ravel()[:n], closes.T.ravel()[:n]


# --- encoding --------------------------------------------------------------------------------

def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[k] .. starts[k] + counts[k] - 1 of all k in turn."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Tokens:
    """Ids of numbered units."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.held = 0
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, units: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """`ids` of the units in turn, so many of each as `counts` says."""
        need = int(units.max(initial=-1)) + 1
        if need > len(self.starts):
            self.starts, self.counts = (np.concatenate([x, np.zeros(2 * need - len(x), np.int64)])
                                        for x in (self.starts, self.counts))
        self.starts[units] = self.held + np.cumsum(counts) - counts
        self.counts[units] = counts
        self.parts.append(ids.astype(np.int32))
        self.held += len(ids)

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a list of units, and how many each has."""
        self.parts = [np.concatenate([np.zeros(0, np.int32), *self.parts])]
        counts = self.counts[units]
        return self.parts[0][ragged(self.starts[units], counts)], counts


class Numbers(dict):
    """Numbers of units, given at their first use; `new` lists them until they are encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.count, self.new = 0, []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = self.count
        self.count += 1
        self.new.append(unit)
        return number


class Tokenizers:
    """Both vocabularies and the units they have encoded."""

    def __init__(self, a_file: str, b_model: str, cache: int = 400_000) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_model)
        back = {c: i for i, c in enumerate(visible_bytes())}
        self.a_bytes = {i: bytes(back[c] for c in w) for w, i in self.a.get_vocab(False).items() if all(c in back for c in w)}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = {i: bytes([int(w[3:5], 16)]) if self.b.is_byte(i) else w.replace(BLANK, " ").encode()
                        for i, w in enumerate(names) if not (self.b.is_control(i) or self.b.is_unknown(i))}
        self.blank = next((i for i, w in enumerate(names) if w == BLANK), -1)
        whole = [w.replace(BLANK, " ") for i, w in enumerate(names) if i in self.b_bytes and not self.b.is_byte(i)]
        # With such a piece, or one with a line break, texts are not cut.
        self.cuts = not any("\n" in w or re.search("[^ ] ", w) for w in whole)
        self.b_list = [self.b_bytes.get(i, b"") for i in range(len(names))]
        self.a_size, self.b_size = sizes_of(self.a_bytes), sizes_of(self.b_bytes)
        self.quick = ranked(json.loads(self.a.to_str()), self.a_bytes)
        self.cache = cache
        self.clear()

    def clear(self) -> None:
        self.known, self.bad = Numbers(), set()
        self.a_ids, self.b_ids = Tokens(), Tokens()

    def pair(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """A and B ids of texts that follow a blank, and whether both give back blank and text."""
        a = [e.ids for e in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        return a, b, [self._same(" " + t, x, y) for t, x, y in zip(texts, a, b)]

    def pair_of_lines(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """The same of texts that begin with a line break and follow nothing: B's blank is taken off."""
        a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        good = [y[:1] == [self.blank] and self._same(t, x, y[1:]) for t, x, y in zip(texts, a, b)]
        return a, [y[1:] for y in b], good

    def _same(self, text: str, a: list[int], b: list[int]) -> bool:
        raw, a_bytes, b_bytes = text.encode(), self.a_bytes, self.b_bytes
        return (b"".join([a_bytes.get(i, b"") for i in a]) == raw
                and b"".join([b_bytes.get(i, b"") for i in b]) == raw)

    def _add(self, units: list[int], a: list[list[int]], b: list[list[int]], good: list[bool]) -> None:
        self.bad.update(u for u, g in zip(units, good) if not g)
        for tokens, lists in ((self.a_ids, a), (self.b_ids, b)):
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            tokens.add(np.array(units, np.int64), np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts)

    def _learn_row(self, units: list[str]) -> bool:
        """Encode units one behind the other in one text, in which no token crosses their borders.  False
        if that is not so."""
        text = " x" + "".join(units)
        a, b = self.quick.encode_ordinary(text), self.b.encode(text[1:])
        raw = text.encode()
        if self.quick.decode_bytes(a) != raw or b"".join(map(self.b_list.__getitem__, b)) != raw:
            return False
        ends = np.cumsum([2, *(len(u.encode()) for u in units)])
        found = []
        for ids, size in ((np.array(a), self.a_size), (np.array(b), self.b_size)):
            at = np.cumsum(size[ids])
            upto = np.searchsorted(at, ends)
            if (at[upto] != ends).any():
                return False
            found.append((ids[upto[0] + 1:], np.diff(upto)))
        numbers = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        self.a_ids.add(numbers, *found[0]), self.b_ids.add(numbers, *found[1])
        return True

    def _learn(self, units: list[str]) -> None:
        """Encode new units, each of which begins with a blank or a line break.  Those that end in white space
        or hold B's own blank sign stand alone."""
        plain = [u for u in units if not u[-1].isspace() and BLANK not in u] if self.quick else []
        rows = [plain[i:i + ROW] for i in range(0, len(plain), ROW)]
        done = {u for row in rows if self._learn_row(row) for u in row}
        rest = [u for u in units if u not in done]
        for some, first, run in (([u for u in rest if u[0] == " "], 1, self.pair), ([u for u in rest if u[0] != " "], 0, self.pair_of_lines)):
            if some:
                self._add([self.known[u] for u in some], *run([u[first:] for u in some]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids and B ids of all texts in turn, and how many of each every text has."""
        if self.known.count > self.cache or self.a_ids.held > 16 * self.cache:
            self.clear()
        number = self.known.__getitem__
        rows = [list(map(number, UNIT.findall(" " + t))) if t and self.cuts and not ODD.search(t) else [] for t in texts]
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        whole = [k for k, row in enumerate(rows) if texts[k] and not (row and self.bad.isdisjoint(row))]
        for k in whole:
            a, b, (good,) = self.pair([texts[k]])
            rows[k] = [self.known.count]
            self.known.count += 1
            self._add(rows[k], a if good else [[]], b if good else [[]], [True])
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        units = np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))
        (a, a_counts), (b, b_counts) = self.a_ids.of(units), self.b_ids.of(units)
        return a, b, sums(a_counts, sizes), sums(b_counts, sizes)


def sizes_of(table: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(table) + 1, np.int64)
    out[list(table)] = [len(x) for x in table.values()]
    return out


def ranked(spec: dict, words: dict[int, bytes]):
    """The A vocabulary as an encoder by ranks, which is several times as fast as by merge rules and gives
    the same ids where merged tokens are numbered in the order of their rules; None where they are not
    or where texts are prepared otherwise than by the byte-level pattern."""
    import tiktoken

    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True)) == ("ByteLevel", False, True)
    merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if spec.get("normalizer") or not plain or any(x >= y for x, y in zip(merged, merged[1:])):
        return None
    special = {t["id"] for t in spec.get("added_tokens") or []}
    return tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={w: i for i, w in words.items() if i not in special})


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


@functools.lru_cache(1)
def tokenizers_of(a_file: str, b_model: str) -> Tokenizers:
    """One pair per worker process: its units serve the tasks that follow."""
    return Tokenizers(a_file, b_model)


# --- a slice of texts ------------------------------------------------------------------------

@functools.lru_cache(1)
def decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. most, left-aligned, with room for one sign more, and their numbers."""
    width = len(str(most))
    numbers = np.arange(most + 1)
    sizes = np.char.str_len(numbers.astype(f"S{width}")).astype(np.int64)
    digits = np.zeros((most + 1, width + 1), np.uint8)
    digits[:, :width] = np.frombuffer(numbers.astype(f"S{width}").tobytes(), np.uint8).reshape(-1, width)
    return digits, sizes


@dataclass
class Aligned:
    """Tokens, groups and links of a slice of texts, one text after another."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]  # sha256 of the groups' texts
    links: np.ndarray  # A id << 32 | B id of every link

    @property
    def n_links(self) -> np.ndarray:
        return self.n_a + self.n_b - self.n_groups


def group_texts(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2` of consecutive runs of groups.  Group g has the A tokens up to a_ends[g] and the B
    tokens up to b_ends[g] that no group before has; run k has the groups up to ends[k]."""
    a_sizes, b_sizes = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    # A token's place: all tokens of the groups before, and for B tokens those of A in the same group.
    a_places = np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)
    b_places = np.arange(len(b)) + np.repeat(a_ends, b_sizes)
    ids = np.empty(len(a) + len(b), np.int64)
    ids[a_places], ids[b_places] = a, b
    digits, sizes = decimals(99_999 if ids.max(initial=0) <= 99_999 else int(ids.max()))
    text, length = digits[ids], sizes[ids]
    sign = np.full(len(ids), ord(","), np.uint8)
    sign[a_places[a_ends - 1]] = ord("|")
    sign[b_places[b_ends - 1]] = ord(";")
    text[np.arange(len(ids)), length] = sign
    flat = text[np.arange(text.shape[1]) <= length[:, None]].tobytes()
    upto = np.concatenate([[0], np.cumsum(length + 1)])
    tokens = np.concatenate([[0], a_ends + b_ends])[np.concatenate([[0], ends])]
    cuts = upto[tokens].tolist()
    return [flat[s:max(s, e - 1)] for s, e in zip(cuts, cuts[1:])]  # without the last sign


def align(texts: list[str], tokenizers: Tokenizers) -> Aligned:
    a, b, n_a, n_b = tokenizers.encode(texts)
    # Texts follow each other: the ends of both lists meet at the end of every text.
    at_a, at_b, closes = merge_path(np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b]))
    linked = ~closes
    links = a[at_a[linked]].astype(np.int64) << 32 | b[at_b[linked]]
    a_ends, b_ends = at_a[closes].astype(np.int64), at_b[closes].astype(np.int64) + 1
    upto = np.searchsorted(b_ends, np.cumsum(n_b), side="right")
    parts = group_texts(a, b, a_ends, b_ends, upto)
    groups = [sha256(part).hexdigest() if n else "" for part, n in zip(parts, n_b.tolist())]
    return Aligned(n_a, n_b, np.diff(upto, prepend=0), groups, links)


# --- links as numbers of a chunk's pairs -----------------------------------------------------

class Pairs:
    """Distinct pairs of a chunk, numbered as they appear, with their counts."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, np.int64)  # ascending
        self.numbers = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)  # by number

    def number(self, links: np.ndarray) -> np.ndarray:
        """Count links and return the numbers of their pairs; frequent new ones get small numbers."""
        codes, keys = pd.factorize(links)
        counts = np.bincount(codes, minlength=len(keys))
        at = np.searchsorted(self.keys, keys)
        have = at < len(self.keys)
        have[have] = self.keys[at[have]] == keys[have]
        numbers = np.empty(len(keys), np.int64)
        numbers[have] = self.numbers[at[have]]
        fresh = np.flatnonzero(~have)
        numbers[fresh[np.argsort(-counts[fresh], kind="stable")]] = np.arange(len(fresh)) + len(self.keys)
        self.keys = np.concatenate([self.keys, keys[fresh]])
        self.numbers = np.concatenate([self.numbers, numbers[fresh]])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.numbers = self.keys[order], self.numbers[order]
        self.counts = np.concatenate([self.counts, np.zeros(len(fresh), np.int64)])
        self.counts[numbers] += counts
        return numbers[codes]

    def listed(self) -> np.ndarray:
        out = np.empty(len(self.keys), np.int64)
        out[self.numbers] = self.keys
        return out


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, byte planes apart, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


# --- the operator ----------------------------------------------------------------------------

TEXT_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def align_texts(documents: DataFrame, a_file: str, b_model: str, slice_chars: int = 4 << 20,
                chunk_chars: int = 64 << 20) -> DataFrame:
    """The stored alignment: a row per text with its figures and its links, as numbers of its chunk's
    pairs, and a row per chunk with its distinct pairs and their counts.  A slice is aligned at once, the
    slices of a chunk share a list of pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part = tokenizers_of(a_file, b_model), TaskContext.get().partitionId()
        pairs, chunk, seen, ids, texts, held = Pairs(), part << 32, 0, [], [], 0

        def rows(columns: dict, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in kinds],
                schema=kinds)

        def texts_rows() -> pa.RecordBatch:
            found = align(texts, both)
            numbers, cuts = pairs.number(found.links), np.concatenate([[0], np.cumsum(found.n_links)]).tolist()
            return rows({"chunk": [chunk] * len(ids), "doc_id": ids, "n_a": found.n_a, "n_b": found.n_b,
                         "n_groups": found.n_groups, "n_links": found.n_links, "groups_sha256": found.groups,
                         "links": [packed(numbers[s:e]) for s, e in zip(cuts, cuts[1:])]}, len(ids))

        def chunk_row() -> pa.RecordBatch:
            return rows({"chunk": [chunk], "pairs": [pairs.listed()], "times": [pairs.counts]}, 1)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(doc), texts.append(text)
                held += len(text) + 64
                if held >= slice_chars:
                    seen += held
                    yield texts_rows()
                    ids, texts, held = [], [], 0
                    if seen >= chunk_chars:
                        yield chunk_row()
                        pairs, chunk, seen = Pairs(), chunk + 1, 0
        if texts:
            yield texts_rows()
        if len(pairs.keys) or seen or texts:
            yield chunk_row()

    kinds = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                       ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                       ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return stored(slim.mapInArrow(run, f"chunk long, {TEXT_COLUMNS}, links binary, pairs array<long>, times array<long>"),
                  "alignment")


def pair_totals(found: DataFrame) -> DataFrame:
    """pair, n (links that hold it, corpus-wide) and best (whether its B id has no more frequent pair)."""
    each = found.where(F.col("pairs").isNotNull()).select(F.inline(F.arrays_zip("pairs", "times")))
    totals = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = totals.groupBy(b).agg(F.max("n").alias("most"))
    return totals.select("pair", "n", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def token_alignment(documents: DataFrame, a_file: str, b_model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text."""
    found = align_texts(documents, a_file, b_model)
    each = (found.where(F.col("pairs").isNotNull())
            .select("chunk", F.posexplode("pairs").alias("number", "pair"))
            .join(pair_totals(found), "pair").select(F.col("chunk").alias("at"), "number", "n", "best"))

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts.column("number").to_numpy())
        n = counts.column("n").to_numpy()[order]
        best = counts.column("best").to_numpy()[order].astype(np.int64)
        links = [unpacked(x) for x in texts.column("links").to_pylist()]
        figures = {"n_best": pa.array([int(best[x].sum()) for x in links], pa.int64()),
                   "count_sum": pa.array([int(n[x].sum()) for x in links], pa.int64())}
        return pa.table({f: figures[f] if f in figures else texts.column(f) for f in names})

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{f} {'string' if f == 'groups_sha256' else 'long'}" for f in names)
    return (found.where(F.col("pairs").isNull()).drop("pairs", "times").groupBy("chunk")
            .cogroup(each.groupBy("at")).applyInArrow(run, schema))
