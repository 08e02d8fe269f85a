"""Cross-tokenizer alignment against plain loops over the libraries' own encodings of whole texts."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from intakeyard.llm import alignment
from tests.llm.conftest import nasty_rows, prose

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
HOSTILE = ["<|endoftext|> a <s> </s> <0x41>", "a▁b", "  lead", "trail   ", "tab\tnew\n\nline \r\n x", "\x00 nul", "ﬁ é é　c d", "     ",
           "\n", " ", "aaaa" * 40, "ab ab  ab   ab", "it's we'll 12345 don't!!", "東京タワー" * 30, "\U0001F600\U0001F468‍\U0001F469", "x y\x85z", "的" * 3000]


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    from intakeyard.llm.byte_bpe import byte_characters

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(byte_characters())}
    docs, count = [], collections.Counter()
    for t in texts:
        x = a.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        xb = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not t or not (b"".join(xb) == b"".join(yb) == (" " + t).encode()):
            docs.append(([], [], [], 0, 0, ""))
            continue
        links, groups = [], []
        ends_a, ends_b, n = [], [], 0
        for v in xb:
            n += len(v)
            ends_a.append(n)
        n = 0
        for v in yb:
            n += len(v)
            ends_b.append(n)
        i = j = 0
        while i < len(x):
            links.append((x[i], y[j]))
            i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
        cuts, at = sorted(set(ends_a) & set(ends_b)), 0
        for c in cuts:
            groups.append(",".join(str(v) for v, e in zip(x, ends_a, strict=True) if at < e <= c) + "|"
                          + ",".join(str(v) for v, e in zip(y, ends_b, strict=True) if at < e <= c))
            at = c
        docs.append((x, y, links, len(cuts), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        count.update(set(links))
    best = collections.defaultdict(int)
    for (i, _), c in count.items():
        best[i] = max(best[i], c)
    return count, [(len(x), len(y), g, n, sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), h)
                   for x, y, links, g, n, h in docs]


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def rows():
    texts = [r[1] if r[1] is None or len(r[1]) < 4000 else r[1][:4000] for r in nasty_rows()] + HOSTILE + [prose(k, 30) for k in range(40)]
    return list(enumerate(texts))


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 1, 50])
def test_against_plain_loops(spark, rows, heavy):
    """``heavy`` only decides which pairs are looked up in the tasks and which are joined."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pair", F.lit("x")).repartition(4)
    got = {r["id"]: tuple(r[c] for c in COLS) for r in alignment.align(docs, A, B, heavy=heavy, cache=60).collect()}
    _, want = brute([t for _, t in rows])
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}


def test_pair_counts_and_groups(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    table = alignment.aligned(docs, A, B, with_groups=True).cache()
    count, _ = brute([t for _, t in rows])
    got = alignment.pair_counts(table, A, B).collect()
    assert {(r.a_id, r.b_id): r.documents for r in got} == dict(count) and len(got) == len(count)
    assert all((hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") == r.groups_sha256 for r in table.select("groups", "groups_sha256").collect())


def test_empty(empty):
    assert alignment.align(empty, A, B).collect() == []


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "same text here"), (None, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in alignment.align(docs, A, B).select(*COLS).collect())
    _, want = brute(["same text here"] * 3 + [None])
    assert got == sorted(want)
