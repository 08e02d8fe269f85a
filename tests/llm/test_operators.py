"""Each operator against a brute-force version on rows that hold every awkward case, and on an empty table."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from intakeyard.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    line_templates,
    near_dedup,
    quality,
    secret_scan,
    suffix_dedup,
    token_counts,
    toxicity,
)
from tests.llm.conftest import nasty_rows, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [(r[0], r[1]) for r in nasty_rows()]


def sha(b) -> str:
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_exact_dedup(nasty, empty):
    got = exact_dedup.exact_dedup(nasty, heavy=4, counters=16).collect()
    groups = collections.defaultdict(list)
    for i, t in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    want = collections.Counter()
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for k, m in enumerate(members):
            want[(m[2], members[0][2], len(members), k == 0, sha(norm))] += 1
    assert bag(got) == want
    assert exact_dedup.exact_dedup(empty).collect() == []


def test_exact_dedup_without_heavy_names(nasty):
    """The split only decides the route: any number of counters gives the same rows."""
    a, b = (exact_dedup.exact_dedup(nasty, heavy=h, counters=c).collect() for h, c in ((1, 8), (64, 1024)))
    assert bag(a) == bag(b)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows, percent):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

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


@pytest.mark.parametrize("percent", [80, 85])
def test_near_dedup(nasty, empty, percent):
    got = near_dedup.near_dedup(nasty, percent=percent).select("id", "n_shingles", "component_id").collect()
    assert bag(got) == bag(brute_components(ROWS, percent))
    assert near_dedup.near_dedup(empty).collect() == []


def test_near_dedup_in_blocks(nasty, monkeypatch):
    """A bucket cut into many blocks gives the same components."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 4)
    got = near_dedup.near_dedup(nasty).select("id", "n_shingles", "component_id").collect()
    assert bag(got) == bag(brute_components(ROWS, 85))


def test_near_dedup_chains_across_blocks(spark, monkeypatch):
    """Chains whose ends are unlike each other: what the hubs leave open is settled between the blocks."""
    words, other = prose(11, 400).split(), prose(12, 60)
    texts = [" ".join(words[6 * k:6 * k + 120]) for k in range(40)]
    texts += [other + " " + " ".join(words[6 * k:6 * k + 70]) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 2)
    tasks = []
    across = near_dedup.across_blocks
    monkeypatch.setattr(near_dedup, "across_blocks", lambda *a: tasks.append(across(*a)) or tasks[-1])
    for percent in (80, 85):
        got = near_dedup.near_dedup(docs, percent=percent).select("id", "n_shingles", "component_id").collect()
        assert bag(got) == bag(brute_components(list(enumerate(texts)), percent))
    assert tasks and not tasks[0].isEmpty()


def test_posterior_bound():
    for n, m in near_dedup.least_matches(0.85, 1e-6):
        assert 0 < m <= 0.85 * n


def test_token_counts(nasty, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.read_pieces(PIECES)
    exact = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    want = [(i, len(exact.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    got = token_counts.token_counts(nasty, PIECES, carry=["doc_id", "key", "score"], cache=500)
    assert got.columns == ["doc_id", "key", "n_tokens", "score"]
    assert bag(got.select("doc_id", "n_tokens").collect()) == bag(want)
    assert token_counts.token_counts(empty, PIECES).collect() == []


def test_viterbi_ties():
    """Equal scores: the longest last piece wins, as in the library."""
    from tokenizers import Tokenizer, models

    pieces = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁a", -2.0)]
    exact, mine = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False)), token_counts.Counter(pieces, 100)
    for word in ("▁abab", "▁aabba", "▁ababa", "▁zzab", "▁azbz", "▁zaz", "▁"):
        assert mine.totals([word])[0] == [len(exact.encode(word, add_special_tokens=False).ids)], word


def test_byte_bpe(nasty, empty):
    import tiktoken

    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    want = []
    for i, t in ROWS:
        ids = exact.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    got = byte_bpe.byte_bpe(nasty, RANKS, public_tokenizers.PATTERN, carry=["doc_id"], cache=300)
    assert bag(got.collect()) == bag(want)
    assert byte_bpe.byte_bpe(empty, RANKS, public_tokenizers.PATTERN).collect() == []


def test_byte_bpe_offsets(nasty):
    got = byte_bpe.byte_bpe(nasty, RANKS, public_tokenizers.PATTERN, carry=["text"], with_ids=True).collect()
    codec = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN, 1000)
    for r in got:
        text = r.text or ""
        assert b"".join(codec.token_bytes[i].as_py() for i in r.ids).decode() == text
        assert len(r.char_starts) == r.n_tokens and (not r.ids or (r.char_starts[0] == 0 and r.char_ends[-1] == len(text)))
        for s, e, i in zip(r.char_starts, r.char_ends, r.ids, strict=True):
            assert codec.token_bytes[i].as_py() in text[s:e].encode()


def test_secret_queries():
    assert secret_scan.mandatory(r"[0-9a-f]{16,}") == []
    assert secret_scan.mandatory(r"AKIA[A-Z0-9]{14,}") == [[frozenset({"aki", "kia"})]]
    alts = secret_scan.mandatory(secret_scan.BASE[0].regex)[0]
    assert frozenset({"tok", "oke", "ken"}) in alts and frozenset({"api", "pi_", "i_k", "_ke", "key"}) in alts


def test_secret_scan(nasty, empty):
    base = [("assign", re.compile(secret_scan.BASE[0].regex.replace("(?i:", "(?ai:")), 2, 12), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
            ("hex", re.compile(r"[0-9a-f]+"), 0, 16)]
    added = [(r.kind, re.compile(r.regex), 0, 1) for r in secret_scan.ADDED]

    def spans(text, rules):
        found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}", kind) for k, (kind, rx, g, least) in enumerate(rules)
                 for m in rx.finditer(text) if len(m.group(g)) >= least]
        return [x[2:] for x in sorted(found)]

    want = []
    for i, t in ROWS:
        b = spans(t or "", base)
        n = collections.Counter(kind for _, kind in b)
        want.append((i, n["assign"], n["access"], n["hex"], sha(",".join(s for s, _ in b)), ",".join(s for s, _ in spans(t or "", base + added))))
    assert bag(secret_scan.secret_scan(nasty).collect()) == bag(want)
    assert any(w[1] for w in want) and secret_scan.secret_scan(empty).collect() == []


def brute_contamination(docs, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owners = collections.defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[k:k + window])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = word.findall((t or "").translate(LOW)), set(), set()
        for size in {len(x) for x in owners}:
            for k in range(len(w) - size + 1):
                if own := owners.get(tuple(w[k:k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_decontaminate(spark, nasty, empty, limit):
    base = prose(1, 300).split()
    items = [(1, " ".join(base[20:60])), (2, "One TWO"), (3, prose(3, 40)), (3, prose(2, 30)), (4, None), (5, "..."), (None, "three four"), (6, " ".join(base[20:60]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(nasty, table, carry=["doc_id"], limit=limit)
    assert bag(got.collect()) == bag(brute_contamination(ROWS, items))
    assert decontaminate.decontaminate(empty, table, limit=limit).collect() == []
    none = decontaminate.decontaminate(nasty, table.limit(0), carry=["doc_id"], limit=limit)
    assert none.where("n_hit > 0 OR contaminated").count() == 0 and none.count() == len(ROWS)


def brute_repeats(rows, width):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[s:s + width] for b in data for s in range(len(b) - width + 1))
    out = []
    for (i, _), b in zip(rows, data, strict=True):
        runs = []
        for s in range(len(b) - width + 1):
            if seen[b[s:s + width]] > 1:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = s + width
                else:
                    runs.append([s, s + width])
        keep, at = b"", 0
        for s, e in runs:
            keep, at = keep + b[at:s], e
        keep += b[at:]
        out.append((i, len(b), len(b) - len(keep), len(runs), sha(keep)))
    return out


@pytest.mark.parametrize("width", [400, 60])
def test_suffix_dedup(nasty, empty, width):
    assert bag(suffix_dedup.suffix_dedup(nasty, width=width).collect()) == bag(brute_repeats(ROWS, width))
    assert suffix_dedup.suffix_dedup(empty).collect() == []


def test_suffix_dedup_in_chunks(nasty, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 512)
    monkeypatch.setattr(suffix_dedup, "_PLACE", suffix_dedup.np.uint64(4095))
    assert bag(suffix_dedup.suffix_dedup(nasty, width=400).collect()) == bag(brute_repeats(ROWS, 400))


def test_multikey_sort():
    import numpy as np

    r = np.random.default_rng(3)
    a, b, c = (r.integers(0, 6, 500).astype(np.uint64) for _ in range(3))
    order = suffix_dedup.multikey_sort(a, b, c)
    got = list(zip(a[order], b[order], c[order], strict=True))
    assert got == sorted(got) and sorted(order) == list(range(500))


def test_line_templates(nasty, empty):
    got = {(r.doc_id, r.text): r for r in line_templates.line_dedup(nasty, carry=["doc_id", "text", "n"]).collect()}
    assert sum(1 for r in got.values() if r.n_dropped) >= 14
    for r in got.values():
        assert "usual desk" not in (r.kept_text or "")  # 15 texts share the template, numbers differ
        if not r.n_dropped:
            assert r.kept_text == r.text
    assert got[(160, "Contact 4711 at the usual desk for help.")].kept_text == ""
    assert line_templates.line_dedup(empty).collect() == []


def test_line_templates_copies_of_one_text_stay(spark):
    docs = spark.createDataFrame([(k, "the very same line of text\nand another one here") for k in range(40)], "doc_id long, text string")
    assert line_templates.line_dedup(docs).agg(F.sum("n_dropped")).head()[0] == 0


def test_line_templates_long_lines(spark):
    """A line of over 50 tokens recurs from five different texts on, a shorter one from ten on; neighbours stay."""
    line = prose(70, 51)
    assert len(line.split()) == 51
    docs = [(k, prose(500 + k, 20) + "\n" + re.sub("[0-9]", "", line)) for k in range(5)]
    got = line_templates.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), carry=["doc_id", "text"]).collect()
    assert all(r.n_dropped == 1 and r.kept_text == r.text.split("\n")[0] for r in got)
    for rows in (docs[:4], [(i, t.rsplit(" ", 1)[0]) for i, t in docs]):  # one text less, one token less
        got = line_templates.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), carry=["doc_id"]).collect()
        assert all(r.n_dropped == 0 for r in got)


def test_commonest_word_anywhere():
    """The measure is the share of the commonest word, wherever it stands."""
    import numpy as np

    text = "one spam two spam three four spam five six".encode()
    assert text.split()[len(text.split()) // 2] != b"spam"
    assert quality.measures(np.frombuffer(text, np.uint8))[4] == pytest.approx(3 / 9)


def labelled(spark):
    rows = [(k, prose(k, 40 + k % 60) if k % 4 else "SPAM!! " * (20 + k % 30)) for k in range(400)]
    rows += [(400 + k, prose(900 + k, 30) + " you moron scum") for k in range(120)]
    docs = spark.createDataFrame(rows + [(None, None), (9999, ""), (0, "SPAM!! " * 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("SPAM" not in t), int("moron" in t)) for i, t in rows] + [(None, 1, 1), (5, None, None), (777777, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels, dict(rows)


def test_quality(spark, empty):
    docs, labels, texts = labelled(spark)
    model = quality.fit_quality(docs, labels)
    got = quality.quality_scores(docs, model, carry=["doc_id", "score"]).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == int("SPAM" not in texts[r.doc_id]) for r in got if r.doc_id in texts) >= 0.98 * len(texts)
    one_class = quality.fit_quality(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.quality_scores(docs, one_class).collect()} == {0.5}
    assert quality.quality_scores(empty, model).collect() == [] and not quality.fit_quality(empty, labels).fitted


def test_toxicity(spark, empty):
    docs, labels, texts = labelled(spark)
    chain = toxicity.fit_chain(docs, labels)
    got = toxicity.toxicity(docs, chain, carry=["doc_id"]).collect()
    assert len(got) == docs.count()
    assert sum(r.predicted == int("moron" in texts[r.doc_id]) for r in got if r.doc_id in texts) >= 0.98 * len(texts)
    assert [len(m) for m in chain.models] == [len(chain.vocabulary.hashes) + 1, len(chain.vocabulary.hashes) + 2]  # the second sees the first
    none = toxicity.fit_chain(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(empty, chain).collect() == []
    assert toxicity.toxicity(docs, toxicity.fit_chain(empty, labels)).count() == docs.count()
