"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character, longest
first; dynamic programming keeps, per character, the best score of a path that ends there, its piece count
and whether its last piece is unknown. No segmentation is stored.

The rules are those of the ``tokenizers`` library's Unigram model behind its Metaspace pre-tokenizer:
spaces become the mark, a mark is put in front, a word begins at each mark; a better score wins and of equal
scores the longest last piece (the path found first); a character that is no piece itself may be unknown at
the lowest score minus 10, and neighbouring unknown pieces count as one.

Texts are scored where they are read: no shuffle, memory bounded by the word table (``cache`` words of 64 characters
at most, those that came again stay longest; longer words are scored each time they come) and a batch.
Defined results: null and empty texts count zero pieces with score zero; repeated rows and null
ids pass through; very long words cost time in proportion to their length; an empty table gives an empty result;
other columns are not read unless named in ``carry``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.llm.common import documents
from intakeyard.llm.pieces import LONGEST
from intakeyard.session import ship_package

MARK, APART, PENALTY = "▁", "\0", 10.0
#: Words kept per Python worker, at most some 150 MB of them.
CACHE = 400_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file, without control, unknown and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def bare_words_of(text: str) -> list[str]:
    """Words without the mark that each begins with."""
    return text.replace(" ", MARK).removeprefix(MARK).split(MARK) if text else []


def words_of(text: str) -> list[str]:
    return [MARK + w for w in bare_words_of(text)]


class Counter:
    """Piece counts and scores of words; one per Python worker."""

    def __init__(self, pieces: list[tuple[str, float]], cache: int):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if APART in piece:
                raise ValueError("a piece holds U+0000")
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        single = "".join(re.escape(p) for p, _ in pieces if len(p) == 1)
        self.apart = re.compile(f"[^{single}]" if single else ".", re.DOTALL)
        self.unknown = min(s for _, s in pieces) - PENALTY
        self.cache = cache
        # counts and scores by the word without its mark; in two, as the garbage collector visits every pair kept but no number
        self.known: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.again: set[str] = set()

    def learn(self, words: list[str]) -> tuple[list[int], list[float]]:
        """Counts and scores: run the automaton once over all words; U+0000, in no piece, keeps matches inside words."""
        line = APART.join(words)
        size = len(line)
        best = [float("-inf")] * (size + 1)
        count, fused = [0] * (size + 1), bytearray(size + 1)
        unknown = self.unknown
        starts = set(accumulate((len(w) + 1 for w in words), initial=0))
        # positions behind a character that is no piece: the unknown path competes last there, or a word starts afresh
        odd = iter([m.end() for m in self.apart.finditer(line)] + [size + 1])
        best[0] = 0.0
        at = next(odd)

        def settle(upto: int, at: int) -> int:
            while at <= upto:
                if at in starts:
                    best[at], count[at], fused[at] = 0.0, 0, 0
                else:
                    score = best[at - 1] + unknown
                    if score > best[at]:
                        best[at], count[at], fused[at] = score, count[at - 1] + (not fused[at - 1]), 1
                at = next(odd)
            return at

        for end, (length, piece) in self.automaton.iter(line):
            end += 1
            if at < end:
                at = settle(end - 1, at)
            score = best[end - length] + piece
            if score > best[end]:
                best[end] = score
                count[end] = count[end - length] + 1
        settle(size, at)
        ends = [end - 1 for end in accumulate(len(w) + 1 for w in words)]
        return [count[end] for end in ends], [best[end] for end in ends]

    def totals(self, texts: list[str]) -> tuple[list[int], list[float]]:
        rows = [bare_words_of(t) for t in texts]
        met = set().union(*rows)
        if len(met) + len(self.known) > self.cache:
            self._thin(self.cache - len(met))
        known = self.known
        self.again.update(met.intersection(known))
        new = list(met.difference(known))
        if new:
            counts, scores = self.learn([MARK + w for w in new])
            known.update(zip(new, counts, strict=True))
            self.score.update(zip(new, scores, strict=True))
        counts, scores = ([sum(map(of.__getitem__, row)) for row in rows] for of in (known, self.score))
        for w in new:
            if len(w) >= LONGEST:
                del known[w], self.score[w]
        return counts, [float(s) for s in scores]

    def _thin(self, room: int) -> None:
        """Words that came again since the last time stay, unless they fill half the room by themselves."""
        stay = self.again if len(self.again) <= min(room, self.cache // 2) else ()
        self.known, self.score = ({w: of[w] for w in stay} for of in (self.known, self.score))
        self.again = set()


_COUNTERS: dict[tuple, Counter] = {}


def token_counts(docs: DataFrame, model_path: str, *, text_col: str = "text", carry: list[str] | None = None, cache: int = CACHE) -> DataFrame:
    """``carry`` columns with ``n_tokens`` and the Viterbi ``score``; added names win over carried ones."""
    ship_package(docs.sparkSession)
    carried = [c for c in carry or [] if c.lower() not in ("n_tokens", "score")]
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__text"))
    schema = T.StructType([*[source.schema[c] for c in carried], T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (model_path, cache)
        if key not in _COUNTERS:
            _COUNTERS[key] = Counter(read_pieces(model_path), cache)
        for big in batches:
            for start in range(0, big.num_rows, 64):
                b = big.slice(start, 64)
                n, s = _COUNTERS[key].totals([t or "" for t in b.column(b.num_columns - 1).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(carried))] + [pa.array(n, pa.int64()), pa.array(s, pa.float64())],
                                                 names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def op4_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])
