"""The pipeline's line stage: what it drops from small planted tables."""

import pytest

from tests.llm.conftest import prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string"


def plain(seed: int, n: int) -> str:
    """Prose without digits whose words are hardly ever the same at the same place."""
    return prose(seed, n).translate(str.maketrans("0123456789", "abcdefghij"))


def staged(spark, texts):
    out = corpus_pipeline.line_stage(spark, spark.createDataFrame(list(enumerate(texts)), COLUMNS).repartition(3), SF)
    return [r.text for r in sorted(out.collect())]


@pytest.mark.parametrize("values", [9, 10])
def test_fields_with_recurring_values(spark, values):
    """A field is variable however often each of its values stands: 9 x 9 and 10 x 10 names and places."""
    bodies = [plain(k, 20) for k in range(values * values)]
    names, places = plain(1001, values).split(), plain(1002, values).split()
    lines = [f"read more articles by {a} in our section on {b} today" for a in names for b in places]
    assert staged(spark, [f"{x}\n{y}" for x, y in zip(bodies, lines, strict=True)]) == bodies


def brute_spread(texts):
    """Heads of each line's tokens, commonest first, as plain sets; lines of up to 50 tokens, no digits."""
    leaves = {}
    for i, t in enumerate(texts):
        for at, line in enumerate(t.split("\n")):
            w = tuple(line.split())
            if len(w) >= 3:
                leaves.setdefault((len(w), w[:3]), []).append((t, i, at, w))
    gone = set()
    for lines in leaves.values():
        seen = {}
        for t, _, _, w in lines:
            for cell in enumerate(w):
                seen.setdefault(cell, set()).add((t, w))
        holders, falls = {}, {}
        for t, i, at, w in lines:
            counts = sorted({len(seen[c]) for c in enumerate(w)}, reverse=True)
            for least in counts:
                firm = frozenset(c for c in enumerate(w) if len(seen[c]) >= least)
                if len(firm) >= 0.75 * len(w):
                    holders.setdefault(firm, set()).add(t)
                    falls.setdefault(firm, set()).add((i, at))
        for firm, members in holders.items():
            if len(members) >= 10:
                gone |= falls[firm]
    return gone


def test_spread_against_brute_force(spark):
    """Two templates and a line of its own in one leaf; a field's usual value makes most of its lines."""
    names, places = plain(1003, 6).split(), plain(1004, 12).split()
    lines = [f"read more articles by {names[k % 6 if k % 3 else 0]} in our section on {places[k % 12]} today" for k in range(60)]
    lines += [f"read more articles while you wait for the {places[k % 12]} bus home" for k in range(9)]
    lines += ["read more articles and then go to bed before ten sharp"]
    texts = [f"{plain(2000 + k, 15)}\n{x}" for k, x in enumerate(lines)]
    gone = brute_spread(texts)
    assert len(gone) == 60
    assert staged(spark, texts) == ["\n".join(x for at, x in enumerate(t.split("\n")) if (i, at) not in gone) for i, t in enumerate(texts)]


def test_near_copies_do_not_lose_their_lines(spark):
    """200 near copies of one text: the line stage leaves them whole, and near-dedup then keeps as few as before it."""
    import random

    from tests.llm.test_operators import brute_components

    lines, r = [plain(3000 + k, 25) for k in range(8)], random.Random(5)
    texts = ["\n".join(" ".join("changed" if r.random() < 0.01 else w for w in x.split()) for x in lines) for _ in range(200)]
    want = sorted({c for _, _, c in brute_components(list(enumerate(texts)), 80)})
    assert len(want) < 10
    after = staged(spark, texts)
    assert after == texts
    out = corpus_pipeline.near_dedup_stage(spark, spark.createDataFrame(list(enumerate(after)), COLUMNS), SF)
    assert sorted(x.doc_id for x in out.collect()) == want


def test_lines_of_near_copies_and_others(spark):
    """A line in 30 near copies of one text and in 9 others goes everywhere (10 groups), in 8 others it stays."""
    line, body = "please subscribe to our weekly letter for more", plain(3100, 200)
    for others in (9, 8):
        texts = [f"{body} {plain(3200 + k, 1)}\n{line}" for k in range(30)] + [f"{plain(3300 + k, 20)}\n{line}" for k in range(others)]
        assert staged(spark, texts) == [t.split("\n")[0] if others == 9 else t for t in texts]


def test_long_lines_of_two_unlike_texts(spark):
    """A line of 51 tokens goes from two unlike texts, a line of 50 does not; two near copies keep theirs."""
    line = plain(70, 51)
    texts = [f"{plain(4000 + k, 60)}\n{line}" for k in range(2)]
    assert staged(spark, texts) == [t.split("\n")[0] for t in texts]
    shorter = [t.rsplit(" ", 1)[0] for t in texts]
    assert staged(spark, shorter) == shorter
    copies = [f"{plain(4100, 200)} {plain(4200 + k, 1)}\n{line}" for k in range(2)]
    assert staged(spark, copies) == copies


def test_short_and_numeric_lines_that_are_the_same(spark):
    """Lines of one and two tokens and a phone line go from ten texts on; lines of numbers that differ and white lines stay."""
    same = "Advertisement\n Read  more\nTel 0800 123 456"
    texts = [f"{plain(5000 + k, 20)}\n{same}\n\nPage {k}\n{k}" for k in range(10)]
    assert staged(spark, texts) == [t.replace(f"\n{same}", "") for t in texts]
    assert staged(spark, texts[:9]) == texts[:9]
