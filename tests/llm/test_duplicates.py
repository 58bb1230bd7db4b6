"""Line, document, vector and substring duplicates, and nearest neighbours, against brute force."""

import collections
import hashlib
import re

import numpy as np
import pytest

from vitrine.llm import embedding_dedup, line_dedup, ngram_join, permutation_index, suffix_dedup
from tests.conftest import SF


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- n-gram join ---------------------------------------------------------------------------

def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_components(pairs, n, percent):
    sets = [(i, shingle_set(t, n)) for i, t in pairs]
    groups = Groups()
    for x, (i, s) in enumerate(sets):
        groups.find(i)
        for j, t in sets[:x]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                groups.link(i, j)
    return {i: groups.find(i) for i, _ in sets}, {i: len(s) for i, s in sets}


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_ngram_join_matches_brute_force(docs, rows, n, percent):
    want, sizes = brute_components(list(rows.items()), n, percent)
    got = ngram_join.join(docs, n, percent).collect()
    assert {r.id: r.component for r in got} == want
    assert {r.id: r.size for r in got} == sizes


def test_ngram_join_chains_and_thresholds(spark):
    base = [f"w{i}" for i in range(102)]
    chain = [" ".join([*base[:i], *(f"x{j}" for j in range(i)), *base[i:]]) for i in range(12)]
    small = ["a b c d e f g h i j k l", "a b c d e f g h i j k", "a b c d e f g h i j", "q r s", "Q R S", "q r", "q"]
    texts = list(enumerate(chain + small + small))
    want, _ = brute_components(texts, 3, 90)
    got = ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90).collect()
    assert {r.id: r.component for r in got} == want


@pytest.mark.parametrize("percent", [80, 90])
def test_postings_meet_for_every_linked_pair(percent):
    rng = np.random.default_rng(9)
    for size in [*range(1, 40), 60, 99, 150, 400]:
        bands = ngram_join.Bands({size: 50, 2 * size: 9}, 4 * size + 10, percent)
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            drop, add = rng.integers(0, size // 4 + 1), rng.integers(0, size // 4 + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 62, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if len(b) and both and 100 * both >= percent * (len(a) + len(b) - both):
                assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size


def test_sets_without_common_shingles_share_no_postings():
    """Segments that two sets leave empty are no reason to compare them."""
    random = np.random.default_rng(12)
    bands = ngram_join.Bands({1200: 1000}, 5000, 80)
    sigs = [np.unique(bands.signatures(np.unique(random.integers(0, 1 << 62, size).astype(np.uint64))))
            for size in random.integers(1120, 1380, 300)]
    _, times = np.unique(np.concatenate(sigs), return_counts=True)
    assert (times > 1).sum() <= 3


def test_postings_meet_where_few_segments_are_filled():
    """Sets that differ in fewer segments than are posted meet, however many of them are empty."""
    random = np.random.default_rng(13)
    bands = ngram_join.Bands({9: 5}, 9, 80)
    for exact, zone in [(1, 1), (1, 4), (2, 5), (4, 6), (5, 5)]:
        bands.plan = [(zone, zone, exact, 0)] * len(bands.plan)
        for _ in range(400):
            pool = random.integers(0, 1 << 62, 9).astype(np.uint64)
            a, b = (pool[random.random(9) < random.random()] for _ in range(2))
            if len(np.setxor1d(a, b)) < exact:
                assert np.intersect1d(bands._postings(a, 2), bands._postings(b, 2)).size


def test_allocations_keep_the_pigeonhole():
    used = set()
    for sets in (1, 1000, 10**9):
        for size in (1, 9, 10, 25, 70, 500, 5000):
            need = size // 4 + 1
            m, exact, loose = ngram_join.allocate(size, need - 1, sets, share=0.2)
            assert exact + 2 * loose >= need and exact + loose <= m
            used.add(loose > 0)
    assert used == {False, True}


def test_ngram_join_odd_rows(odd, nothing):
    got = ngram_join.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[0] == {(0, 0)} and by[2] == {(0, 2)} and by[3] == {(1, 3)} and by[4] == {(1, 3)}
    assert by[6] == {(next(iter(by[6]))[0], 6)} and next(iter(by[7]))[1] == 6
    assert ngram_join.near_duplicates(nothing).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns and [r.doc_id for r in kept.collect()].count(3) == 1


@pytest.mark.parametrize("percent", [80, 90])
def test_parities_never_drop_a_link(spark, percent):
    random, base = np.random.default_rng(5), np.arange(400, dtype=np.uint64) << np.uint64(40)
    sets = [np.unique(np.concatenate([base[random.random(400) < keep], random.integers(0, 1 << 60, 9).astype(np.uint64)]))
            for keep in np.linspace(0.6, 1, 40)]
    rows = [(i, j, ngram_join.parities(a), ngram_join.parities(b), len(a), len(b), 100 * (both := len(np.intersect1d(a, b)))
             >= percent * (len(a) + len(b) - both)) for i, a in enumerate(sets) for j, b in enumerate(sets)]
    frame = spark.createDataFrame(rows, "i int, j int, x array<bigint>, y array<bigint>, s long, t long, link boolean")
    kept = frame.where(ngram_join.may_link("x", "y", "s", "t", percent)).collect()
    assert sum(r.link for r in kept) == sum(r[-1] for r in rows) > 40
    assert len(kept) < 0.6 * len(rows)


def test_texts_that_only_share_parts_are_not_compared(spark, monkeypatch):
    tested, compare = [], ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *rest: tested.append(pairs.count()) or compare(pairs, *rest))
    random, base = np.random.default_rng(7), [f"w{i}" for i in range(200)]
    texts = [[f"x{k}_{i}" if i in drop else w for i, w in enumerate(base)]
             for k, drop in enumerate(random.choice(200, 12, replace=False) for _ in range(120))]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert all(r.component == r.id for r in ngram_join.join(docs).collect())
    assert tested[-1] < 100


def test_rows_without_ids_or_with_repeated_ones_are_apart(spark):
    words = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    made = [(None, words[0]), (None, words[1]), (None, words[1] + " more"), (7, words[2]), (7, words[3]),
            (8, words[3] + " more"), (9, words[4]), (None, words[4]), (None, ""), (None, None), (10, words[5])]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    kept = collections.Counter((r.doc_id, r.text) for r in ngram_join.one_of_each(frame).collect())
    second = kept[(None, words[1])]
    assert second + kept[(None, words[1] + " more")] == 1
    want = [made[0], made[1] if second else made[2], *made[3:5], made[6], *made[8:]]
    assert kept == collections.Counter(want)
    got = {r.n_shingles and (r.doc_id, r.component_id) for r in ngram_join.near_duplicates(frame).collect()}
    assert got == {0, (None, None), (7, 7), (8, 7), (9, 9), (None, 9), (10, 10)}


# --- lines ---------------------------------------------------------------------------------

def brute_lines(pairs, k=8, percent=80):
    seen, first = [], {}
    for doc, text in sorted(pairs, key=lambda r: r[0]):
        for at, line in enumerate((text or "").split("\n")):
            if line.strip():
                seen.append((doc, at, line))
                first.setdefault(line, (doc, at))
    sets = {line: {line[i:i + k] for i in range(max(1, len(line) - k + 1))} for line in first}
    holders = collections.defaultdict(list)
    groups = Groups()
    for line, s in sets.items():
        near = collections.Counter(o for g in s for o in holders[g])
        for other, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[other]) - both):
                a, b = sorted([first[line], first[other]])
                groups.link(a, b)
        for g in s:
            holders[g].append(line)
    gone = collections.defaultdict(list)
    for doc, at, line in seen:
        if groups.find(first[line]) != (doc, at):
            gone[doc].append(at)
    return gone


def test_line_dedup_matches_brute_force(docs, rows):
    want = brute_lines(rows.items())
    got = line_dedup.line_counts(docs).collect()
    assert len(got) == len(rows)
    different = [r.doc_id for r in got if r.removed != want[r.doc_id]]
    assert len(different) <= 1  # banding may miss a pair near the threshold
    assert all(r.n_lines == (rows[r.doc_id] or "").count("\n") + 1 for r in got)


def test_near_lines_are_linked(spark):
    line = "the quick brown fox jumps over the lazy dog and then goes on to the next long field of {} clover"
    texts = [(1, line.format("red") + "\nunlike words stand here alone\n\nend"), (2, line.format("rad") + "\nown line"),
             (3, line.format("red") + "\nend\nother " + "z" * 200), (4, "tiny\ntinyy\ntiny")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(frame).collect()}
    assert got == {1: texts[0][1], 2: "own line", 3: "other " + "z" * 200, 4: "tiny\ntinyy"}


def test_line_signatures_cover_all_chunks(spark):
    from pyspark.sql import functions as F

    text = "".join(chr(97 + i * i % 23) for i in range(500))
    frame = spark.createDataFrame([(1, text), (2, text[:70]), (3, "short")], "doc_id long, text string")
    lines = line_dedup._lines(frame)
    got = {r.name: r for r in line_dedup.signatures(lines, 8, 2, 2).collect()}
    h = frame.select("doc_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("text") - 7, F.lit(1))), lambda i: F.substring("text", i, F.lit(8)))).alias("g"))
    h = h.select("doc_id", F.xxhash64("g").alias("h")).select(
        "doc_id", F.pmod("h", F.lit(4)).alias("bin"), F.shiftrightunsigned("h", 33).alias("v"))
    want = {(r.doc_id, r.bin): r.v for r in h.groupBy("doc_id", "bin").agg(F.min("v").alias("v")).collect()}
    for r in lines.collect():
        for b in range(4):
            low = want.get((r.id, b))
            assert got[r.name][f"b{b}"] in (low, None)
            assert got[r.name][f"b{b}"] == low or low > 5.0 * 4 * 2**31 / len(r.line)


def test_long_lines_that_repeat_themselves_are_linked(spark):
    rng = np.random.default_rng(6)
    units = ["".join(rng.choice(list("abcdefghij"), n)) for n in (3, 7, 12, 25, 40, 60) for _ in range(8)]
    texts = [u * (6000 // len(u)) for u in units]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup._lines(frame)
    exact = {tuple(r) for r in line_dedup._minima(lines, 8, 18, None).drop("size").collect()}
    assert {tuple(r) for r in line_dedup.signatures(lines, 8, 6, 3).collect()} == exact
    near = [*texts, *(t + " end" for t in texts)]
    got = line_dedup.line_counts(spark.createDataFrame(list(enumerate(near)), "doc_id long, text string"))
    want = brute_lines(enumerate(near))
    assert sum(map(len, want.values())) > 10
    assert {r.doc_id: r.removed for r in got.collect() if r.removed} == {i: r for i, r in want.items() if r}


def test_line_dedup_is_native(docs):
    frame = line_dedup.line_counts(docs.limit(20))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_line_dedup_odd_rows(odd, nothing):
    got = line_dedup.line_counts(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[0].n_lines == 0 and by[2].removed == []
    want = brute_lines({r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}.items())
    assert all(r.removed == want[r.doc_id] for r in got if r.doc_id is not None)
    assert line_dedup.line_counts(nothing).count() == 0
    kept = line_dedup.without_repeats(odd)
    texts = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert kept.columns == odd.columns and texts[(0, None)] == 1 and texts[(1, "")] == 1
    assert texts[(3, "one")] == 3 and (4, "one") not in texts


# --- vectors -------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, node long, n int"


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").cache()


@pytest.fixture(scope="module")
def crowd(spark):
    """Random vectors, near copies around some of them, exact copies, scaled copies and bad rows."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 16))
    near = [base[i % 7] / np.linalg.norm(base[i % 7]) + rng.normal(size=16) * 0.05 for i in range(500)]
    every = [*base, *near, *[base[0]] * 200, *[3 * base[1]] * 20]
    made = [(i, [float(x) for x in v], i % 3, 1, 1) for i, v in enumerate(every)]
    n = len(made)
    made += [(n, None, 1, 1, 1), (n + 1, [], 1, 1, 1), (n + 2, [0.0] * 16, 1, 1, 1), (n + 3, [1.0, None] * 8, 1, 1, 1),
             (n + 4, [float("nan")] * 16, 1, 1, 1), (n + 5, [float(x) for x in base[0]], None, 1, 1),
             (n + 6, [float(x) for x in base[2][:8]], 1, 1, 1), (5, made[5][1], made[5][2], 1, 1), (None, made[9][1], 0, 1, 1)]
    return spark.createDataFrame(made, VECTORS).cache()


def usable(e):
    return e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)


def brute_links(rows):
    counts, groups = [], Groups()
    units = [np.array(r.embedding, float) / np.linalg.norm(r.embedding) if usable(r.embedding) and r.label is not None
             else None for r in rows]
    for i, (r, u) in enumerate(zip(rows, units)):
        groups.find(i)
        n = 0
        for j, v in enumerate(units):
            if i != j and u is not None and v is not None and len(u) == len(v) and r.label == rows[j].label:
                if u @ v >= 0.93:
                    n += 1
                    groups.link(i, j)
        counts.append(n)
    smallest = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            g = groups.find(i)
            smallest[g] = min(r.vec_id, smallest.get(g, r.vec_id))
    return [(r.vec_id, n, smallest.get(groups.find(i))) for i, (r, n) in enumerate(zip(rows, counts))]


@pytest.mark.parametrize("which,cell_rows", [("vectors", 1500), ("vectors", 60), ("crowd", 100)])
def test_vector_links_match_brute_force(request, monkeypatch, which, cell_rows):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    frame = request.getfixturevalue(which)
    rows = [r for r in frame.collect() if r.vec_id is not None]
    frame = frame.where("vec_id is not null")
    got = embedding_dedup.near_duplicates(frame, cell_rows=cell_rows, reach=1.0).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute_links(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_visitors_of_a_cell_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 10)
    rows = [("l", [1.0], i, 1, [0, 1] if i < 3 else [1, 0]) for i in range(3 + 50)] + [("l", [1.0], 60, 1, [2, 5])]
    placed = spark.createDataFrame(rows, "label string, embedding array<double>, node long, n long, cells array<int>")
    dealt = embedding_dedup.deal(placed).collect()
    blocks = {c: {r.own for r in dealt if r.cell == c and r.home == c} for c in (0, 1, 2)}
    assert all(r.i in blocks[r.cell] and r.own in (r.i, r.j) for r in dealt)
    # Cell 0: three rows at home with five blocks of visitors; cell 1 the other way round; cell 5 has no home.
    assert sum(r.cell == 0 for r in dealt) == 3 * 6 + 50
    assert sum(r.cell == 1 for r in dealt) == 50 * 6 + 3 * 5
    assert {r.cell for r in dealt} == {0, 1, 2}


def test_default_reach_finds_the_links(crowd):
    frame = crowd.where("vec_id is not null")
    found = sum(r.n_links for r in embedding_dedup.near_duplicates(frame, cell_rows=100).collect())
    assert found >= 0.99 * sum(n for _, n, _ in brute_links(frame.collect()))


def test_vector_dedup_of_nothing(spark, crowd):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    assert embedding_dedup.near_duplicates(crowd).count() == crowd.count()


def brute_nearest(rows, k=20):
    good = [(r.vec_id, np.array(r.embedding, float)) for r in rows if usable(r.embedding) and r.vec_id is not None]
    return {q: sorted({(-float(v @ e), i) for i, e in good if i != q and len(e) == len(v)})[:k]
            for q, v in good if q % 20 == 0}


@pytest.mark.parametrize("which", ["vectors", "crowd"])
def test_neighbours_recall(request, which):
    frame = request.getfixturevalue(which)
    want = brute_nearest(frame.collect())
    got = collections.defaultdict(list)
    for r in permutation_index.nearest(frame).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == {q for q, w in want.items() if w}
    hits = sum(len({i for _, i in w} & {i for i, _ in got[q]}) for q, w in want.items())
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, own in got.items():
        assert own == sorted(own, key=lambda r: (-r[1], r[0])) and len(own) == len(want[q])


def test_neighbours_recall_when_files_are_cut(spark):
    """More rows than a file reranks whole: the footrule ranking decides."""
    x = np.random.default_rng(4).normal(size=(6000, 24))
    frame = spark.createDataFrame([(i, [float(v) for v in r], 0, 0, 0) for i, r in enumerate(x)], VECTORS)
    got = collections.defaultdict(set)
    for r in permutation_index.nearest(frame, least=64).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 6000, 20):
        s = x.astype(np.float32).astype(float) @ x[q].astype(np.float32).astype(float)
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & got[q])
    assert hits >= 0.9 * 300 * 20


def neighbour_hits(frame, x, least=64):
    """Share of the exact neighbours, by score and id, that the index finds."""
    got = collections.defaultdict(set)
    for r in permutation_index.nearest(frame, least=least).collect():
        got[r.query_id].add(r.vec_id)
    hits, x = 0, x.astype(np.float32).astype(float)
    for q in range(0, len(x), 20):
        s = np.round(x @ x[q], 9)
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(len(x)), -s))[:20].tolist()) & got[q])
    return hits / (len(x) / 20 * 20)


def vector_frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r], 0, 0, 0) for i, r in enumerate(x)], VECTORS)


def test_neighbours_when_the_first_ids_are_copies(spark):
    x = np.random.default_rng(5).normal(size=(6000, 24))
    x[:1000] = x[0] + np.random.default_rng(6).normal(size=(1000, 24)) * 1e-3
    x[:500] = x[0]
    assert neighbour_hits(vector_frame(spark, x[:, :24]), x) >= 0.85


def test_neighbours_within_a_large_group_of_copies(spark):
    x = np.random.default_rng(7).normal(size=(6000, 24))
    x[::3] = x[1]
    got = collections.defaultdict(list)
    for r in permutation_index.nearest(vector_frame(spark, x), least=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    copies = [1, *range(0, 6000, 3)]
    for q in range(0, 6000, 60):
        assert got[q] == [i for i in sorted(copies) if i != q][:20]
    assert neighbour_hits(vector_frame(spark, x), x) >= 0.9


def test_footrule_and_best_ids():
    random = np.random.default_rng(8)
    for pivots, kind in [(1, np.uint8), (128, np.uint8), (256, np.uint8), (300, np.uint16)]:
        rank = np.argsort(random.random((70, pivots)), axis=1)
        far = permutation_index.footrule(np.ascontiguousarray(rank.T.astype(kind)), rank[3].astype(kind))
        assert far.tolist() == np.abs(rank - rank[3]).sum(1).tolist()
    for count, names, scores in [(0, 9, 9), (5, 9, 9), (300, 5, 200), (300, 1000, 4), (300, 30, 1), (300, 1000, 1000)]:
        ids, score = random.integers(0, names, count), random.integers(0, scores, count) / 2
        most = {i: max(score[ids == i]) for i in set(ids.tolist())}
        got = permutation_index.first(ids, score, 20)
        assert [(-score[p], ids[p]) for p in got] == sorted((-s, i) for i, s in most.items())[:20]


def test_posted_rows_are_stored_and_moved_seldom(spark, monkeypatch):
    """A vector is stored once, not once for every file, and answers are those of blocks cut by themselves."""
    kept, store = {}, permutation_index.stored
    monkeypatch.setattr(permutation_index, "stored", lambda df, label: kept.setdefault(label, store(df, label)))
    x = np.random.default_rng(9).normal(size=(3000, 8))
    frame = vector_frame(spark, x)
    answers = {}
    for joined, queries in [(1, 16), (3, 64)]:
        kept.clear()
        for name, value in (("ROWS", 64), ("JOINED", joined), ("QUERIES", queries), ("BATCH", 100)):
            monkeypatch.setattr(permutation_index, name, value)
        found = permutation_index.nearest(frame, least=16)
        answers[joined] = [(r.query_id, r.rank, r.vec_id) for r in found.orderBy("query_id", "rank").collect()]
        assert kept["ann-index"].count() == 3000 and kept["ann-queries"].count() == 150
    assert answers[1] == answers[3] and len(answers[1]) == 150 * 20


def test_neighbours_of_nothing(spark):
    assert permutation_index.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_nearest_of_any_id(spark):
    """Ids at the ends of the range are candidates like others; rows without one take no part."""
    ids = [-(1 << 63), -4611686018427387909, -20, None, 20, (1 << 63) - 1]
    rows = [(i, [1.0, float(n)], "a") for n, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = [tuple(r) for r in permutation_index.nearest(frame).where("query_id = 20").orderBy("rank").collect()]
    assert got == [(20, n + 1, i, 1.0 + 4.0 * x) for n, (x, i) in enumerate(
        sorted(((x, i) for x, i in enumerate(ids) if i not in (None, 20)), key=lambda p: -p[0]))]


# --- repeated substrings -------------------------------------------------------------------

def brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def check_repeats(spark, texts, length, gram):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(frame, length, gram).orderBy("id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got] == \
        brute_repeats(texts, length)


def test_repeats_match_brute_force(docs, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduplicated(docs).collect()}
    assert list(got[i] for i in rows) == brute_repeats(rows.values(), 400)


def test_repeats_of_periods_edges_and_characters(spark):
    rng = np.random.default_rng(8)
    noise = lambda n: "".join(rng.choice(list("abcdé漢 \n"), n))
    shared = noise(60)
    texts = ["a" * 300, "ab" * 100, "a" * 39, "a" * 40, shared, noise(30) + shared[:45] + noise(20), shared[5:] + noise(9),
             noise(80) + shared + noise(70) + shared, None, "", shared, "a" * 41, *(noise(50) + shared[i:] for i in range(20))]
    check_repeats(spark, texts, 40, 8)
    check_repeats(spark, texts, 40, 12)


def test_repeats_across_bucket_borders(spark, monkeypatch):
    """Many variants of one passage, sorted into many small buckets."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", 5)
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdefgh"), 300))
    texts = [base[:i] + "#" + base[i + 1:] for i in range(0, 300, 3)]
    check_repeats(spark, texts, 50, 10)


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    made = [bytes(rng.integers(97, 99, rng.integers(0, 40)).astype(np.uint8)) for _ in range(500)]
    order = suffix_dedup.multikey_quicksort(made)
    assert [made[i] for i in order] == sorted(made)


def test_repeats_odd_rows(odd, nothing):
    got = suffix_dedup.deduplicated(odd).collect()
    assert len(got) == odd.count()
    want = collections.Counter(zip((r.doc_id for r in odd.collect()), brute_repeats((r.text for r in odd.collect()), 400)))
    assert collections.Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == want
    assert suffix_dedup.deduplicated(nothing).count() == 0


def counted(monkeypatch, module):
    """The numbers of pairs that the module's operator verifies."""
    seen, real = [], module.verified

    def verified(pairs, *args, **named):
        seen.append(pairs.count())
        return real(pairs, *args, **named)

    monkeypatch.setattr(module, "verified", verified)
    return seen


def half_alike(n, common, own):
    """Texts that share a part and have words of their own, and one more text near the first."""
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(common + n * own)]
    texts = [" ".join(words[:common] + words[common + i * own:common + (i + 1) * own]) for i in range(n)]
    return texts + [texts[0] + " x"]


def test_unlike_lines_of_a_band_are_not_verified(spark, monkeypatch):
    texts = half_alike(80, 30, 12)
    seen = counted(monkeypatch, line_dedup)
    got = line_dedup.line_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if r.removed] == [80]
    assert 1 <= sum(seen) <= 80


def test_unlike_sets_of_a_signature_are_not_verified(spark, monkeypatch):
    texts = half_alike(60, 60, 20)
    seen = counted(monkeypatch, ngram_join)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = ngram_join.one_of_each(frame).collect()
    assert sorted(r.doc_id for r in kept) == list(range(60))
    assert 1 <= sum(seen) <= 10


def test_line_shingles_are_of_characters(spark):
    lines = ["", "ab", "abcdefgh", "aébcd☃efghé", "éç " * 9, "\U0001f600 and more"]
    frame = spark.createDataFrame([(t,) for t in lines], "line string")
    got = [set(r.h) for r in frame.select(line_dedup.shingles("line", 8).alias("h")).collect()]
    for t, hashes in zip(lines, got):
        assert len(hashes) == len({t[i:i + 8] for i in range(max(1, len(t) - 7))})
