"""SentencePiece encoding and decoding with distinct sampled segmentations.

The pieces of a vocabulary span a lattice over a text.  A piece of score `s` weighs 1 / (base - s),
so frequent pieces weigh more (Zipf's law over the ranks that the scores of a merge vocabulary are);
a segmentation's probability is the product of its weights over the sum of all segmentations.
Gumbel top-k draws `k` distinct segmentations without replacement, in order of their perturbed
log-probabilities.

Pieces never cross the borders of units (blanks before a word, the word, line ends), so a text's
lattice is a chain of unit lattices.  Sums over the rest of each unit give exact conditional
probabilities, and a perturbed A* search works on sets of segmentations: the best one of a set is an
ordinary conditional sample; what remains splits into the sets that agree with it up to some unit and
differ there; the perturbed bound of each such set is a Gumbel variable of its log-mass truncated at
its parent's value.  The set with the largest bound is opened next, and its best segmentation is the
next sample.  The (k+1)-th value is the threshold kappa of the inclusion score
1 - exp(-exp(log p - kappa)).

All random numbers come from a hash of the row's id and the position, so reruns and lost tasks
repeat them.  Lattices are built once per distinct unit of a bounded slice of texts.

Defined cases: null and empty texts have one empty segmentation of probability 1; texts with fewer
than `k` segmentations give all of them, the last with inclusion score 1; characters outside the
vocabulary, line ends and the blank's own stand-in are written as byte pieces.  Rows that repeat are
sampled alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import NO_ID, row_id, whole_text

BLANK = "▁"
# Units of an escaped text: blanks with the word behind them, or one line end.
UNIT = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
BASE = 3.0
MARK = "\ud800"  # never part of a text: replaces the blank's stand-in in the input


def slot_of(key: np.ndarray) -> np.ndarray:
    return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)


class Vocabulary:
    """Pieces, their log weights and a trie as arrays, read from a SentencePiece model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = np.array([model.is_control(i) or model.is_unknown(i) for i in range(n)])
        byte = np.array([model.is_byte(i) for i in range(n)])
        ranks = np.array([-model.get_score(i) if model.get_score(i) > -1e6 else n for i in range(n)])
        weight = 1.0 / (BASE + np.maximum(ranks, 0))
        weight[byte] = weight.min()
        self.log_weight = np.log(weight / weight[~special].sum())
        self.byte_ids = np.zeros(256, np.int32)
        for i in np.flatnonzero(byte):
            self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.surface = [bytes([int(p[3:5], 16)]) if byte[i] else b"" if special[i] else
                        p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        children: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i in np.flatnonzero(~special & ~byte):
            piece = self.pieces[i]
            if "\n" in piece or BLANK in piece.lstrip(BLANK):
                continue  # would cross a unit's border
            node = 0
            for c in piece:
                node = children.setdefault((node, ord(c)), len(children) + 1)
            ends[node] = int(i)
        # Steps (node, character) in an open-addressing table, sparse enough for short probes.
        self.slots = np.full(1 << 18, -1, np.int64)
        self.slot_to = np.zeros(1 << 18, np.int64)
        for (a, c), to in children.items():
            key = (a << 21) | c
            at = int(slot_of(np.array([key]))[0])
            while self.slots[at] >= 0:
                at = (at + 1) & (len(self.slots) - 1)
            self.slots[at], self.slot_to[at] = key, to
        self.ends = np.full(len(children) + 1, -1, np.int64)
        for node, i in ends.items():
            self.ends[node] = i

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = (node << 21) | char
        at = slot_of(key)
        found = self.slots[at]
        result = np.where(found == key, self.slot_to[at], -1)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            found = self.slots[at[open_]]
            hit = found == key[open_]
            result[open_[hit]] = self.slot_to[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return result

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation: the escaped text without its leading blank."""
        raw = b"".join([self.surface[i] for i in ids])
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


class Lattices:
    """The lattices of many units as flat arrays.

    Position `p` of the joined units has the edges edge_start[p] .. edge_start[p + 1], each with its
    conditional probability.
    A byte edge stands for all bytes of its character.
    """

    def __init__(self, units: list[str], vocabulary: Vocabulary) -> None:
        v = vocabulary
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        text = "".join(units)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        ends = np.cumsum(lengths)
        self.start = ends - lengths
        self.chars = chars
        n = len(chars)
        end_of = np.repeat(ends, lengths)
        at = np.arange(n)
        node = np.zeros(n, np.int64)
        froms, tos, ids = [], [], []
        here, depth = at, 0
        while len(here):
            node = v.step(node, chars[here + depth])
            alive = node >= 0
            here, node = here[alive], node[alive]
            depth += 1
            piece = v.ends[node]
            done = piece >= 0
            froms.append(here[done])
            tos.append(here[done] + depth)
            ids.append(piece[done])
            more = here + depth < end_of[here]
            here, node = here[more], node[more]
        covered = np.zeros(n, bool)
        if froms:
            covered[froms[0]] = True
        bare = np.flatnonzero(~covered)  # no single-character piece: bytes
        width = 1 + (chars[bare] > 0x7F) + (chars[bare] > 0x7FF) + (chars[bare] > 0xFFFF)
        froms.append(bare)
        tos.append(bare + 1)
        ids.append(np.full(len(bare), -1))
        source, target, piece = map(np.concatenate, (froms, tos, ids))
        weight = np.where(piece >= 0, v.log_weight[piece], 0.0)
        byte_weight = float(v.log_weight[v.byte_ids[0]])
        weight[len(piece) - len(bare):] = width * byte_weight
        order = np.argsort(source, kind="stable")  # runs of rising sources merge fast
        source, target, piece, weight = source[order], target[order], piece[order], weight[order]
        self.edge_start = np.searchsorted(source, np.arange(n + 1))
        # Log-sum of all ways from a position to its unit's end, farthest from the end last.
        rest = np.zeros(n + 1)  # index of a unit's end is also the next unit's start: kept apart below
        far = end_of - at
        by_far = np.argsort(far, kind="stable")
        cuts = np.searchsorted(far[by_far], np.arange(1, (int(far.max()) if n else 0) + 2))
        closes = target == end_of[source]
        for d in range(len(cuts) - 1):
            where = by_far[cuts[d]:cuts[d + 1]]
            if not len(where):
                continue
            first, count = self.edge_start[where], self.edge_start[where + 1] - self.edge_start[where]
            offset = np.cumsum(count) - count
            edge = np.repeat(first - offset, count) + np.arange(count.sum())
            value = weight[edge] + np.where(closes[edge], 0.0, rest[target[edge]])
            top = np.maximum.reduceat(value, offset)
            rest[where] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, count)), offset))
        log_edge = weight + np.where(closes, 0.0, rest[target]) - rest[source]
        # The likeliest edge of a position first: drawing one mostly looks at one.
        order = np.argsort(source - 0.5 * np.exp(log_edge), kind="stable")
        self.log_edge, self.target = log_edge[order], target[order]
        self.piece, self.closes = piece[order], closes[order]
        self.share = np.exp(self.log_edge)

    def sample(self, unit: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One path through each of the given units: (owner, edge) of all its pieces in order of
        owners, and the log-probability of each path.  `keys` seed each path's random numbers."""
        place = self.start[unit]
        log_p = np.zeros(len(unit))
        active = np.arange(len(unit))
        owners, edges = [], []
        step, u = 0, np.zeros(0)
        while len(active):
            if step % 4 == 0:  # what an edge leaves of a random number serves the next three
                u = uniform(keys[active] + np.uint64(step * 0x9E3779B1 + 1))
            e = self.edge_start[place]
            share = self.share[e]
            final = self.edge_start[place + 1] - 1
            later = np.flatnonzero((u >= share) & (e < final))
            while len(later):
                u[later] -= share[later]
                e[later] += 1
                share[later] = self.share[e[later]]
                later = later[(u[later] >= share[later]) & (e[later] < final[later])]
            u = np.minimum(u / share, 1.0)
            log_p[active] += self.log_edge[e]
            owners.append(active)
            edges.append(e)
            go = ~self.closes[e]
            place, active, u = self.target[e][go], active[go], u[go]
            step += 1
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), log_p
        owner, edge = np.concatenate(owners), np.concatenate(edges)
        order = np.argsort(owner, kind="stable")
        return owner[order], edge[order], log_p


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1."""
    return ((mixed(x) >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def truncated(log_mass: np.ndarray, bound: float, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of location `log_mass`, conditioned to lie below `bound`."""
    with np.errstate(divide="ignore", over="ignore"):
        return -np.logaddexp(-bound, np.log(-np.log(u)) - log_mass)


class Search:
    """Perturbed A* over the segmentations of one text.  An open set agrees with a sample up to some
    unit and differs from it, and from earlier choices, there; it holds its perturbed bound."""

    def __init__(self, units: np.ndarray, keys: np.ndarray, seed: int, log_p: np.ndarray,
                 edges: np.ndarray, sizes: np.ndarray) -> None:
        self.units, self.keys, self.seed, self.used = units, keys, seed, 0
        self.paths = [(log_p, edges, sizes)]
        # The root's mass is one; a text without units has a single segmentation.
        self.values = [float(-np.log(-np.log(self._draw(1)[0]))) if len(units) else 0.0]
        self.fronts: list[tuple[int, np.ndarray, np.ndarray, int, list[bytes]]] = []
        self.kappa = -np.inf
        self.at, self.banned = 0, []
        self._open(0, -1, [], 0.0)

    def _draw(self, count: int) -> np.ndarray:
        base = np.uint64((self.seed * 0x2545F4914F6CDD1D + 77 + self.used) & 0xFFFFFFFFFFFFFFFF)
        self.used += count
        return uniform(mixed(np.arange(count, dtype=np.uint64) + base))

    def _open(self, sample: int, since: int, banned: list[bytes], gone: float) -> None:
        """Split what a new sample leaves of its set: one set for each unit from `since` on."""
        if not len(self.units):
            return
        lp = self.paths[sample][0]
        shut = np.exp(lp)
        if since >= 0:
            shut[since] += gone
        live = 1.0 - shut > 1e-12
        live[:max(0, since)] = False
        bound = np.full(len(lp), -np.inf)
        if live.any():
            mass = (np.cumsum(lp) - lp)[live] + np.log1p(-shut[live])
            bound[live] = truncated(mass, self.values[sample], self._draw(len(mass)))
        self.fronts.append((sample, bound, shut, since, banned))

    def _best(self) -> tuple[int, int, float]:
        tops = [(f[1].max(), i) for i, f in enumerate(self.fronts)]
        if not tops:
            return -1, -1, -np.inf
        value, i = max(tops)
        return i, int(self.fronts[i][1].argmax()), float(value)

    def take(self) -> bool:
        """Take the open set with the largest bound; False if none is left."""
        i, at, value = self._best()
        if value == -np.inf:
            return False
        sample, bound, shut, since, banned = self.fronts[i]
        bound[at] = -np.inf
        lp, edges, sizes = self.paths[sample]
        cut = int(sizes[:at].sum())
        own = edges[cut:cut + sizes[at]].tobytes()
        self.banned = [*(banned if at == since else []), own]
        self.at, self.parent, self.cut, self.gone = at, sample, cut, float(shut[at])
        self.values.append(value)
        return True

    def add(self, path: np.ndarray, log_p: float, tail_log: np.ndarray, tail: np.ndarray,
            tail_sizes: np.ndarray) -> None:
        lp, edges, sizes = self.paths[self.parent]
        at = self.at
        self.paths.append((np.concatenate([lp[:at], [log_p], tail_log]),
                           np.concatenate([edges[:self.cut], path, tail]),
                           np.concatenate([sizes[:at], [len(path)], tail_sizes])))
        self._open(len(self.paths) - 1, at, self.banned, self.gone)

    def threshold(self, k: int) -> None:
        if len(self.paths) == k:
            self.kappa = self._best()[2]

    def results(self, k: int) -> Iterator[tuple[np.ndarray, float, float, float]]:
        for (lp, edges, _), value in zip(self.paths[:k], self.values):
            total = float(lp.sum())
            sure = self.kappa == -np.inf
            yield edges, total, value, 1.0 if sure else float(-np.expm1(-np.exp(min(700.0, total - self.kappa))))


class Sampler:
    def __init__(self, vocabulary: Vocabulary, k: int) -> None:
        self.v, self.k = vocabulary, k

    def encode(self, texts: list[str], seeds: np.ndarray) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text its samples: piece ids, log-probability, perturbed value, inclusion score."""
        known: dict[str, int] = {}
        flat, counts = [], []
        for text in texts:
            # The stand-in of the blank, if a text holds it, is written in bytes: a private mark.
            escaped = BLANK + text.replace(BLANK, MARK).replace(" ", BLANK) if text else ""
            own = [known.setdefault(u, len(known)) for u in UNIT.findall(escaped)]
            counts.append(len(own))
            flat.append(np.array(own, np.int64))
        lattices = Lattices(list(known), self.v)
        units = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        ends = np.cumsum(counts)
        place = np.arange(len(units)) - np.repeat(ends - counts, counts)
        keys = mixed(np.repeat(seeds, counts) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        owner, edge, log_p = lattices.sample(units, keys)
        bounds = np.searchsorted(owner, np.arange(len(units) + 1))
        searches = []
        for n, end, seed in zip(counts, ends, seeds.tolist()):
            lo = end - n
            searches.append(Search(units[lo:end], keys[lo:end], seed, log_p[lo:end],
                                   edge[bounds[lo]:bounds[end]], np.diff(bounds[lo:end + 1])))
        for round_ in range(1, self.k):
            self._extend(lattices, [s for s in searches if s.take()], round_)
        for s in searches:
            s.threshold(self.k)
        return [[(self._ids(lattices, edges), total, value, inclusion)
                 for edges, total, value, inclusion in s.results(self.k)] for s in searches]

    def _extend(self, lattices: Lattices, searches: list[Search], round_: int) -> None:
        """The best segmentation of the set each search has taken: its unit anew without the excluded
        ones, the units behind it freely.  All searches draw the latter together."""
        if not searches:
            return
        chosen = []
        for i, key in enumerate(mixed(np.array([s.keys[s.at] for s in searches], np.uint64)
                                      + np.uint64(round_ * 1_000_003)).tolist()):
            chosen.append(self._other(lattices, int(searches[i].units[searches[i].at]), searches[i].banned, key))
        tails = [s.units[s.at + 1:] for s in searches]
        keys = np.concatenate([s.keys[s.at + 1:] for s in searches])
        o, e, q = lattices.sample(np.concatenate(tails), mixed(keys + np.uint64(round_ * 15_485_863 + 3)))
        sizes = np.bincount(o, minlength=len(keys))
        at = np.cumsum([0, *map(len, tails)])
        edge_at = np.concatenate([[0], np.cumsum(sizes)])[at]
        for j, s in enumerate(searches):
            s.add(*chosen[j], q[at[j]:at[j + 1]], e[edge_at[j]:edge_at[j + 1]], sizes[at[j]:at[j + 1]])

    def _other(self, lattices: Lattices, unit: int, banned: list[bytes], key: int) -> tuple[np.ndarray, float]:
        """One segmentation of a unit given that it is none of the excluded ones.  An edge weighs its
        share less what the excluded paths that have come this way hold of it."""
        shut = []  # edges of each excluded path, and the probability of what follows each edge
        for b in banned:
            edges = np.frombuffer(b, np.int64)
            after = np.cumsum(lattices.log_edge[edges][::-1])[::-1]
            shut.append((edges.tolist(), np.exp(np.append(after[1:], 0.0)).tolist()))
        at, path, log_p = int(lattices.start[unit]), [], 0.0
        while True:
            edges = range(int(lattices.edge_start[at]), int(lattices.edge_start[at + 1]))
            left = []
            for e in edges:
                share = float(lattices.share[e])
                held = sum(after[len(path)] for b, after in shut if b[len(path)] == e)
                left.append(share * (1.0 - held) if held < 1.0 - 1e-13 else 0.0)
            u = float(uniform(np.array([(key + len(path) * 0x9E3779B1) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]) * sum(left)
            pick = next((i for i, x in enumerate(np.cumsum(left).tolist()) if u < x), len(left) - 1)
            e = edges[pick]
            path.append(e)
            log_p += float(lattices.log_edge[e])
            shut = [x for x in shut if x[0][len(path) - 1] == e]
            if lattices.closes[e]:
                return np.array(path, np.int64), log_p
            if not shut:  # nothing excluded lies ahead
                rest, log_rest = self._free(lattices, int(lattices.target[e]), key + len(path))
                return np.concatenate([np.array(path, np.int64), rest]), log_p + log_rest
            at = int(lattices.target[e])

    def _free(self, lattices: Lattices, at: int, key: int) -> tuple[np.ndarray, float]:
        """One segmentation of the rest of a unit."""
        path, log_p = [], 0.0
        while True:
            u = float(uniform(np.array([(key * 31 + len(path) * 0x9E3779B1 + 7) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])
            e, last = int(lattices.edge_start[at]), int(lattices.edge_start[at + 1]) - 1
            while e < last and u >= lattices.share[e]:
                u -= float(lattices.share[e])
                e += 1
            path.append(e)
            log_p += float(lattices.log_edge[e])
            if lattices.closes[e]:
                return np.array(path, np.int64), log_p
            at = int(lattices.target[e])

    def _ids(self, lattices, edges: np.ndarray) -> np.ndarray:
        ids = lattices.piece[edges]
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids.astype(np.int32)
        parts, done = [], 0
        for i in bare.tolist():
            parts.append(ids[done:i])
            c = chr(int(lattices.chars[lattices.target[edges[i]] - 1]))
            raw = (BLANK if c == MARK else c).encode("utf-8", "replace")
            parts.append(self.v.byte_ids[np.frombuffer(raw, np.uint8)])
            done = i + 1
        return np.concatenate([*parts, ids[done:]]).astype(np.int32)


SLICE = 3 << 17  # characters sampled together


def sample_segmentations(documents: DataFrame, model: str, k: int = 2, seed: int = 5) -> DataFrame:
    """doc_id, sample (1 to k), ids, log_p, perturbed and inclusion: up to k rows for every document."""
    rows = documents.select(row_id().alias("id"), whole_text().alias("text"),
                            F.xxhash64(row_id(), F.lit(seed)).alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(Vocabulary(model), k)
        for batch in batches:
            ids, text = batch.column("id").to_pylist(), batch.column("text")
            seeds = batch.column("seed").to_numpy().view(np.uint64)
            long = pc.utf8_length(text).to_pylist()
            lo = 0
            while lo < len(ids):
                hi, size = lo, 0
                while hi < len(ids) and (hi == lo or size + long[hi] <= SLICE):
                    size += long[hi]
                    hi += 1
                found = sampler.encode(text.slice(lo, hi - lo).to_pylist(), seeds[lo:hi])
                flat = [(d, j + 1, *s) for d, own in zip(ids[lo:hi], found) for j, s in enumerate(own)]
                lens = np.cumsum([0, *(len(f[2]) for f in flat)]).astype(np.int32)
                values = np.concatenate([f[2] for f in flat]) if flat else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([f[0] for f in flat], pa.int64()),
                    "sample": pa.array([f[1] for f in flat], pa.int32()),
                    "ids": pa.ListArray.from_arrays(lens, pa.array(values, pa.int32())),
                    "log_p": pa.array([f[3] for f in flat], pa.float64()),
                    "perturbed": pa.array([f[4] for f in flat], pa.float64()),
                    "inclusion": pa.array([f[5] for f in flat], pa.float64())})
                lo = hi

    out = rows.mapInArrow(run, "doc_id long, sample int, ids array<int>, log_p double, perturbed double, "
                               "inclusion double")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The same rows with `text` decoded from `ids`; null ids give null."""
    from vitrine.llm.common import map_texts

    holder: list[Vocabulary] = []

    def run(lists: list) -> list[list]:
        if not holder:
            holder.append(Vocabulary(model))
        return [[None if ids is None else holder[0].decode(ids) for ids in lists]]

    return map_texts(encoded.withColumn("__ids", F.col("ids")), "__ids", "text string", run)
