"""The blocked product against plain sets, and texts built to make weak hashes collide."""

import collections
import re

import numpy as np
import pytest

from intakeyard.llm import near_dedup, ngram_join
from intakeyard.llm.shingles import shingle_hashes
from tests.llm.conftest import nasty_rows, prose
from tests.llm.test_operators import LOW, brute_components

ROWS = [(r[0], r[1]) for r in nasty_rows()]


def grams(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, percent):
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def joined(docs, percent):
    return bag(ngram_join.ngram_join(docs, percent=percent).select("id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("percent", [90, 60])
def test_against_plain_sets(nasty, empty, percent):
    assert joined(nasty, percent) == bag(brute(ROWS, percent))
    assert ngram_join.ngram_join(empty).collect() == []


def test_groups_in_many_blocks(spark, monkeypatch):
    """Chains of near copies, unlike texts around a shared passage, one hot line: blocks, column blocks and hubs give all links."""
    words, hot = prose(21, 300).split(), "the same line in every text of this table " * 2
    texts = [" ".join(words[3 * k:3 * k + 120]) for k in range(30)] + [hot + prose(400 + k, 6) for k in range(40)] + [hot] * 5
    texts += [prose(22, 100).replace("alpha", f"alpha{k}", 2) for k in range(25)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 3)
    for percent in (90, 70):
        assert joined(docs, percent) == bag(brute(rows, percent))


@pytest.mark.parametrize("columns", [1, 7, 4096])
def test_product(monkeypatch, columns):
    monkeypatch.setattr(ngram_join, "COLUMNS", columns)
    rng = np.random.default_rng(columns)
    for _ in range(20):
        base = rng.random(60) < 0.6
        sets = [set(np.flatnonzero(base ^ (rng.random(60) < rng.choice([0.0, 0.03, 0.1, 0.5]))).tolist()) for _ in range(25)] + [set()]
        doc = np.array([i for i, s in enumerate(sets) for _ in s], np.int64)
        gram = np.array([g for s in sets for g in sorted(s)], np.uint64)
        for percent in (90, 85, 50):
            got = ngram_join.overlap_links(doc, gram, np.array([len(s) for s in sets]), percent)
            want = [[i != j and bool(a and b) and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
            assert got.tolist() == want
            tree = ngram_join.forest(got)
            assert all(want[i][j] for i, j in tree) and len(tree) == len(sets) - _parts(want)


@pytest.mark.parametrize("factor", [1, 300])
def test_condensed_product_discards_no_link(factor):
    """Whatever the counts, also above what a byte holds, a pair that links is left."""
    rng = np.random.default_rng(3)
    base = rng.random(60 * factor) < 0.6
    sets = [set(np.flatnonzero(base ^ (rng.random(len(base)) < rng.choice([0.0, 0.03, 0.1, 0.5]))).tolist()) for _ in range(20)]
    cells = [np.minimum(np.bincount(np.array(sorted(s)) % 3, minlength=ngram_join.PROFILE), 255).astype(np.uint8) for s in sets]
    size, root = np.array([len(s) for s in sets]), np.arange(20) // 2
    for percent in (90, 50):
        got = ngram_join.possible_links(np.array(cells), size, root, percent)
        assert (got == got.T).all()
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                link = 100 * len(a & b) >= percent * len(a | b)
                assert got[i, j] or not link or root[i] == root[j]
                assert not (got[i, j] and root[i] == root[j])


def _parts(adj):
    seen, n = set(), 0
    for s in range(len(adj)):
        if s not in seen:
            n, todo = n + 1, [s]
            while todo:
                i = todo.pop()
                if i not in seen:
                    seen.add(i)
                    todo += [j for j, v in enumerate(adj[i]) if v]
    return n


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_texts_made_to_collide(spark):
    """A Thue-Morse string and its complement collide under any polynomial hash modulo a power of two."""
    one, two = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    rows = [(1, one), (2, two), (3, one + " x y z w"), (4, two + " x y z w"), (5, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_dedup(docs).select("id", "n_shingles", "component_id").collect()
    assert bag(got) == bag(brute_components(rows, 85))
    assert joined(docs, 90) == bag(brute(rows, 90))


def test_shingles_of_few_words():
    x, n = shingle_hashes([[b"a", b"b"], [b"b", b"a"], [b"a"], [], [b"a", b"b", b"c"], [b"ab"], [b"a", b"b", b"c", b"d"]], 3)
    assert n.tolist() == [1, 1, 1, 0, 1, 1, 2] and len(set(x.tolist())) == 6 and x[3] == x[5]


def test_repeats_made_to_collide(spark):
    """Windows whose polynomial hashes collide are told apart by their bytes, whole runs by their digest."""
    from intakeyard.llm import suffix_dedup
    from tests.llm.test_operators import brute_repeats

    one, two = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    for width, rows in ((1024, [(1, one), (2, two), (3, "x" + one[:1500]), (4, two[300:] + "y")]), (2048, [(1, one), (2, two), (3, "x" + two)])):
        got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()
        assert bag(got) == bag(brute_repeats(rows, width))
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=70_000)
