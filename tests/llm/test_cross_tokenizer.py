"""Token alignment against the libraries on whole texts and plain loops."""

import collections
import random
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vitrine.llm import cross_tokenizer as ct
from vitrine.llm.common import TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def both():
    return ct.Tokenizers(A, B)


@pytest.fixture(scope="module")
def plain(both):
    """Figures of a whole text from the libraries: n_a, n_b, n_groups, links, groups_sha256."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def run(text):
        none = 0, 0, 0, [], ""
        if not text:
            return none
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        parts = [[both.a_bytes[i] for i in a], [both.b_bytes.get(i, b"") for i in b]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return none
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        starts = [[0, *e[:-1]] for e in ends]
        links, first_b = [], 0
        for x, s, e in zip(a, starts[0], ends[0]):
            while ends[1][first_b] <= s:
                first_b += 1
            j = first_b
            while j < len(b) and starts[1][j] < e:
                links.append((x, b[j]))
                j += 1
        cuts, groups = sorted({*ends[0]} & {*ends[1]}), []
        place = [0, 0]
        for cut in cuts:
            upto = [e.index(cut, p) + 1 for e, p in zip(ends, place)]
            groups.append("|".join(",".join(map(str, ids[p:u])) for ids, p, u in zip((a, b), place, upto)))
            place = upto
        return len(a), len(b), len(cuts), links, sha256(";".join(groups).encode()).hexdigest()

    return run


def whole(rows, plain):
    """The rows the operator returns for (doc_id, text)."""
    found = [(i, *plain(t)) for i, t in rows]
    counts = collections.Counter(x for f in found for x in f[4])
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(i, a, b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for i, a, b, g, links, digest in found]


def same(df, rows, plain):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(whole(rows, plain), key=repr)


def test_whole_table(docs, rows, plain):
    same(ct.token_alignment(docs, A, B), rows.items(), plain)


def test_many_chunks(docs, rows, plain, monkeypatch):
    """Slices and chunks of a few texts: counts still cover all."""
    some = docs.where("doc_id < 60").repartition(2, "doc_id")
    want = [(i, t) for i, t in rows.items() if i < 60]
    run = ct.align_texts

    def small(*args):
        found = run(*args, slice_chars=6_000, chunk_chars=20_000)
        assert found.select("chunk").distinct().count() > 4
        return found

    monkeypatch.setattr(ct, "align_texts", small)
    same(ct.token_alignment(some, A, B), want, plain)


def test_odd_rows(odd, nothing, plain):
    same(ct.token_alignment(odd, A, B), [(r.doc_id, r.text) for r in odd.collect()], plain)
    assert ct.token_alignment(nothing, A, B).collect() == []
    empty = odd.where("text is null or text = ''")
    same(ct.token_alignment(empty, A, B), [(r.doc_id, r.text) for r in empty.collect()], plain)


def test_texts_that_are_hard_to_cut(both, plain):
    draw = random.Random(5)
    signs = [" \n\t\r;{aé}x1'sT漢", " \n\t\r;aé▁x{}1'sT漢\x1c\x85　"]
    texts = ["".join(draw.choice(signs[k % 2]) for _ in range(40)) for k in range(600)]
    texts += [" ", "  ", "\n", "a\n", "\na", "a \n b", "a\t b\tc ", "<|endoftext|> <s> </s> <unk> <0x41>", "x" * 3000,
              " ab " * 500, ";\r\n;\r", "\x00", "a\x1db", "ok ▁", "😀" * 50]
    got = ct.align(texts, both)
    cuts = np.concatenate([[0], np.cumsum(got.n_links)])
    for k, text in enumerate(texts):
        a, b, groups, links, digest = plain(text)
        assert (got.n_a[k], got.n_b[k], got.n_groups[k], got.groups[k]) == (a, b, groups, digest), repr(text)
        found = got.links[cuts[k]:cuts[k + 1]]
        assert sorted(zip((found >> 32).tolist(), (found & 0xFFFFFFFF).tolist())) == sorted(links), repr(text)


@pytest.mark.parametrize("work", [1, 2, 7, 64])
def test_pieces_do_not_depend_on_their_size(work):
    """Diagonals may cut equal ends, groups and long runs of one side."""
    draw = random.Random(work)
    for n in (1, 5, 60, 500):
        a = np.array(sorted(draw.sample(range(1, 4 * n), n - 1)) + [4 * n])
        b = np.array(sorted(draw.sample(range(1, 4 * n), n // 2)) + [4 * n])
        i, j, closes = ct.merge_path(a, b, work)
        starts = [[0, *a[:-1]], [0, *b[:-1]]]
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if starts[0][x] < b[y] and starts[1][y] < a[x]}
        assert sorted(zip(i[~closes].tolist(), j[~closes].tolist())) == sorted(want)
        assert b[j[closes]].tolist() == sorted({*a.tolist()} & {*b.tolist()})


def test_pairs_keep_their_numbers():
    pairs, draw = ct.Pairs(), np.random.default_rng(1)
    parts = [draw.integers(0, 300, 400) << 32 | 7 for _ in range(4)]
    numbers = [pairs.number(p) for p in parts]
    keys = pairs.listed()
    for p, n in zip(parts, numbers):
        assert (keys[n] == p).all() and (ct.unpacked(ct.packed(n)) == n).all()
    found, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert dict(zip(keys.tolist(), pairs.counts.tolist())) == dict(zip(found.tolist(), counts.tolist()))
    assert (pairs.number(np.zeros(0, np.int64)) == []).all() and len(ct.unpacked(ct.packed(np.zeros(0, np.int64)))) == 0
