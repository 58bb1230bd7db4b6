"""The manifest against a plain tree in one process."""

import zlib
from hashlib import sha256

import pytest

from vitrine.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h(*[field(row[c]) for c in merkle.FIELDS])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    for nodes in levels[:-1]:
        yield i, nodes[i ^ 1] if i ^ 1 < len(nodes) else ""
        i //= 2


def plain(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r.lang, []).append(((r.doc_id is not None, r.doc_id or 0, leaf(r)), r))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        langs[name].sort(key=lambda x: x[0])
    trees = {name: climb([key[2] for key, _ in langs[name]]) for name in names}
    top = climb([trees[name][-1][0] for name in names]) if names else []
    for place, name in enumerate(names):
        for i, (key, r) in enumerate(langs[name]):
            steps = [*path(trees[name], i), *path(top, place)]
            now = key[2]
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None:
                now = leaf({**r.asDict(), "n_chars": r.n_chars + 1})
            for at, other in steps:
                now = h(other, now) if at % 2 else h(now, other)
            root = top[-1][0]
            yield r.doc_id, key[2], trees[name][-1][0], root, h(*[s for _, s in steps]), now, now == root


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("height", [1, 3, 10])
def test_proofs_equal_the_plain_tree(docs, height):
    got = merkle.tamper_check(docs, height).collect()
    same(got, plain(docs.collect()))
    assert {r.verified for r in got} == {True, False}


def test_odd_rows(odd, nothing):
    assert odd.where("lang is null").count() > 3
    same(merkle.tamper_check(odd, 2).collect(), plain(odd.collect()))
    assert merkle.tamper_check(nothing).collect() == []


def test_one_row_and_one_language(spark, odd):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for made in ([(5, "a", "en", None, 7)], [(i, "a", None, "s", None) for i in (3, 3, -1)]):
        rows = spark.createDataFrame(made, schema)
        same(merkle.tamper_check(rows, 1).collect(), plain(rows.collect()))


def test_a_tree_of_copies_is_spread_and_proven(spark):
    """Equal rows without id, most of the table, in a tree of many blocks."""
    rows = spark.range(3000).selectExpr("cast(if(id % 100 = 0, id, null) as long) as doc_id", "'one' as text",
                                        "if(id % 3 = 0, 'en', '') as lang", "null as source", "5L as n_chars")
    same(merkle.tamper_check(rows, 4).collect(), plain(rows.collect()))


@pytest.mark.parametrize("height", range(0, 9))
def test_layout(height):
    """Every place once, the root first, and each recursive half in one piece."""
    where = merkle.addresses(height)
    assert sorted(int(x) for level in where for x in level) == list(range((2 << height) - 1)) and where[0][0] == 0

    def spans(first, levels, node):
        found = [int(where[first + d][(node << d) + i]) for d in range(levels) for i in range(1 << d)]
        assert max(found) - min(found) == len(found) - 1
        if levels > 1:
            top = levels // 2
            spans(first, top, node)
            for i in range(1 << top):
                spans(first + top, levels - top, (node << top) + i)

    spans(0, height + 1, 0)


def test_paths_come_from_the_layout():
    leaves = [h(str(i)) for i in range(11)]
    store = merkle.build_block(leaves, 4)
    root = climb(leaves)[-1][0]
    assert store[:32].hex() == root
    for i, x in enumerate(leaves):
        assert merkle.fold(x, merkle.path_steps(store, 11, 4, i)) == root
