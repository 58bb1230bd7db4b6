"""Mixing, LM scoring, language ID, token files and segmentations against plain versions."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import language_id, lm_score, mixing, sentencepiece_sampling as sp, wavelet
from vitrine.llm.common import TOKENIZERS, components

BPE, PIECES = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def in_fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


# --- components ----------------------------------------------------------------------------

def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 250), (250, 210), (7, 90), (90, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), "t").collect()))
    assert all(got[i] == 0 for i in range(41)) and got[90] == 0 and got[210] == got[250] == 200


# --- mixing --------------------------------------------------------------------------------

def test_mixture_meets_targets(docs, rows):
    got = mixing.mixture(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    source = {r.doc_id: r.source for r in docs.collect()}
    assert all(r.size == len(words(rows[r.doc_id])) for r in got)
    total = sum(r.size for r in got)
    size, taken, target, largest = (collections.Counter() for _ in range(4))
    for r in got:
        s = source[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(size))}
    want, free, left = {}, dict(weights), total
    while True:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            want.update(share)
            break
        for s in over:
            want[s] = 3 * size[s]
            left -= want[s]
            del free[s]
    assert all(math.isclose(target[s], want[s], rel_tol=1e-9) for s in size)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in size)


def test_mixture_repeats_and_ignores_partitions(docs):
    one = {r.doc_id: r.copies for r in mixing.mixture(docs).collect()}
    two = {r.doc_id: r.copies for r in mixing.mixture(docs.repartition(7)).collect()}
    assert one == two


def test_mixing_is_unbiased_in_the_tree():
    import pandas as pd

    taken = np.zeros(3)
    for i in range(3000):
        units = pd.DataFrame({"rank": [i * 3, i * 3 + 1, i * 3 + 2], "id": [i * 31, i * 31 + 1, i * 31 + 2], "mark": 0,
                              "share": [0.5, 0.25, 0.75], "weight": [10.0, 20.0, 10.0]})
        out = mixing.meet(units)
        assert math.isclose((out["share"] * out["weight"]).sum(), 17.5)
        taken += out.sort_values("id")["share"].to_numpy()
    assert np.allclose(taken / 3000, [0.5, 0.25, 0.75], atol=0.03)


def test_mixing_odd_rows(odd, nothing):
    got = mixing.mixture(odd).collect()
    assert len(got) == odd.count()
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert len({r.copies for r in got if r.doc_id == 3 and r.source_size == got[0].source_size}) <= 1
    assert mixing.mixture(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    assert mixing.mix(odd).columns == odd.columns


# --- LM scoring ----------------------------------------------------------------------------

def plain_scores(rows, mu=8.0):
    tokens = {d: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)] + [0]
              for d, t in rows}
    train = [t for d, t in tokens.items() if in_fold(d, 5) != 1]
    c = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([1, *t], t))
    history = c + collections.Counter({1: len(train)})
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    out = {}
    for d, t in tokens.items():
        base = sum(math.log10(p(w)) for w in t)
        full = sum(math.log10((pairs[u, w] + mu * p(w)) / (history[u] + mu)) for u, w in zip([1, *t], t))
        out[d] = (len(t), sum(c[w] > 0 for w in t), n, base, full)
    return out


@pytest.mark.parametrize("block", [8 << 20, 40_000])
def test_scores_match_plain_model(docs, rows, monkeypatch, block):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    want = plain_scores(rows.items())
    got = lm_score.score(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, full = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (in_fold(r.doc_id, 5) == 1)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, full, rel_tol=1e-9)


def test_bigrams_help_held_out_texts(docs):
    held = [r for r in lm_score.score(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_conditional_probabilities_sum_to_one():
    text = "a b a c a b"
    tokens = text.split() + ["</s>"]
    c = collections.Counter(tokens)
    p = {w: (c[w] + 0.5) / (len(tokens) + 0.5 * (len(c) + 1)) for w in [*c, "unseen"]}
    pairs = collections.Counter(zip(tokens, tokens[1:]))
    assert math.isclose(sum((pairs["a", w] + 8 * p[w]) / (c["a"] + 8) for w in p), 1.0)


def test_scores_odd_rows(odd, nothing):
    got = lm_score.score(odd).collect()
    assert len(got) == odd.count() and sum(r.doc_id is None for r in got) == 1
    assert {r.n_tokens for r in got if r.doc_id in (0, 1, 2)} == {1}
    assert lm_score.score(nothing).count() == 0


# --- language ID ---------------------------------------------------------------------------

def test_languages_of_held_out_documents(docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = language_id.identify(docs).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (in_fold(r.doc_id, 4) == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_language_inputs_are_texts_only(docs):
    from pyspark.sql import functions as F

    one = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    model = language_id.train(docs)
    blind = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(blind, model, ["doc_id"]).collect()} == one


def test_languages_odd_rows(odd, nothing):
    got = language_id.identify(odd).collect()
    assert len(got) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got if r.doc_id in (0, 1, 2))
    assert language_id.identify(nothing).count() == 0
    assert language_id.drop_rejected(odd).columns == odd.columns
    clash = odd.withColumns({c: F.lit(f"own {c}") for c in ("rejected", "score", "lang_pred", "copies")})
    kept = language_id.drop_rejected(clash)
    assert kept.columns == clash.columns and {r.rejected for r in kept.collect()} <= {"own rejected"}
    assert kept.count() == language_id.drop_rejected(odd).count()


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "alpha beta gamma " * 500
    whole = language_id.bucket_counts(text, 1 << 12)
    monkeypatch.setattr(language_id, "PIECE", 17 * 50)
    assert np.allclose(language_id.bucket_counts(text, 1 << 12), whole, atol=1e-3)


# --- token files ---------------------------------------------------------------------------

def test_wavelet_matrix_operations(tmp_path):
    ids = np.random.default_rng(5).integers(0, 700, 6000).astype(np.uint32)
    docs, lengths, m = wavelet.from_file(wavelet.to_file([4, 9], [1000, 5000], ids))
    assert docs.tolist() == [4, 9] and lengths.tolist() == [1000, 5000]
    assert (m.decode() == ids).all()
    assert all(m.access(i) == ids[i] for i in range(0, 6000, 41))
    for token in (0, 3, 699, 5000):
        assert m.count(token) == (ids == token).sum()
        assert m.count(token, 100, 2077) == (ids[100:2077] == token).sum()
        assert m.places(token) == np.flatnonzero(ids == token).tolist()
    with pytest.raises(IndexError):
        m.place(3, 6000)


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(BPE), wavelet.Encoder(BPE)
    for text in ["", "a  b\n\n c\t d", "Éàü don't 's  x y\x1c q 123½ <|endoftext|> z", "漢字 😀😀  \n x", " lead",
                 "trail  ", "\n\n\n", "a\u0085b 　c", "it's we'll I'VE"]:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_token_files_round_trip(request, which):
    from tokenizers import Tokenizer

    frame, library = request.getfixturevalue(which), Tokenizer.from_file(BPE)
    want, start = [], 0
    every = [(r.doc_id, r.text or "") for r in frame.collect()]
    for doc, text in sorted(every, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, wavelet.token_files(frame, BPE).collect()), key=lambda r: r[1]) == want


def test_token_files_of_nothing(nothing):
    assert wavelet.token_files(nothing, BPE).count() == 0


def test_shards_roll(docs, tmp_path):
    files = wavelet.write_shards(docs, BPE, str(tmp_path / "s"), shard_tokens=20_000)
    assert files.count() > 5 and {f.name for f in (tmp_path / "s").glob("*.wvm")} == {r.name for r in files.collect()}
    got = wavelet.read_shards(files, str(tmp_path / "s"))
    assert sorted(got.collect()) == sorted(wavelet.token_files(docs, BPE).collect())


# --- segmentations -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary(PIECES)


def every_segmentation(text, v):
    index = {p: i for i, p in enumerate(v.pieces) if np.isfinite(v.log_weight[i])}
    escaped, found = sp.BLANK + text.replace(" ", sp.BLANK), {}

    def extend(at, path, weight):
        if at == len(escaped):
            found[tuple(path)] = weight
        for end in range(at + 1, len(escaped) + 1):
            i = index.get(escaped[at:end])
            if i is not None:
                extend(end, [*path, i], weight + v.log_weight[i])

    extend(0, [], 0.0)
    top = np.logaddexp.reduce(list(found.values()))
    return {k: math.exp(w - top) for k, w in found.items()}


def test_samples_follow_the_distribution(vocabulary):
    p, n = every_segmentation("er in", vocabulary), 4000
    seeds = sp.mixed(np.arange(n, dtype=np.uint64) * np.uint64(77))
    got = sp.Sampler(vocabulary, 2).encode(["er in"] * n, seeds)
    first = collections.Counter(tuple(r[0][0].tolist()) for r in got)
    second = collections.Counter(tuple(r[1][0].tolist()) for r in got)
    for path in sorted(p, key=p.get)[-4:]:
        assert abs(first[path] / n - p[path]) < 0.03
        without = sum(p[a] * p[path] / (1 - p[a]) for a in p if a != path)
        assert abs(second[path] / n - without) < 0.03
    assert all(math.isclose(p[tuple(s[0].tolist())], math.exp(s[1]), rel_tol=1e-6) for r in got[:50] for s in r)
    # Horvitz-Thompson: inclusion scores make the samples estimate a total without bias.
    assert abs(np.mean([sum(math.exp(s[1]) / s[3] for s in r) for r in got]) - 1) < 0.02


def test_samples_are_distinct_ordered_and_decode(docs, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sp.decode(sp.sample_segmentations(docs, PIECES, k=3), PIECES).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert r.text == rows[r.doc_id]
    assert set(by) == set(rows)
    for doc, own in by.items():
        own.sort(key=lambda r: r.sample)
        assert len({tuple(r.ids) for r in own}) == len(own) == 3
        assert all(a.perturbed > b.perturbed for a, b in zip(own, own[1:]))
        assert all(0 < r.inclusion <= 1 for r in own)
    assert all(library.decode(own[0].ids) == rows[doc] for doc, own in list(by.items())[:50])


def test_samples_repeat(docs):
    key = lambda r: (r.doc_id, r.sample)
    one = sorted(sp.sample_segmentations(docs.limit(40), PIECES).collect(), key=key)
    few = docs.join(docs.limit(40).select("doc_id"), "doc_id", "left_semi").repartition(5)
    assert one == sorted(sp.sample_segmentations(few, PIECES).collect(), key=key)


def test_samples_odd_rows(odd, nothing):
    got = sp.decode(sp.sample_segmentations(odd, PIECES), PIECES).collect()
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    assert all((r.doc_id, r.text) in texts for r in got)
    assert [r.inclusion for r in got if r.doc_id == 0] == [1.0] and sum(r.doc_id is None for r in got) == 2
    assert sp.sample_segmentations(nothing, PIECES).count() == 0
