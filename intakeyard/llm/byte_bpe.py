"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

The rank file is turned into a ``tokenizers`` BPE: every byte gets a printable character
(the usual byte-to-character table) and every split of a token into two earlier tokens
becomes a merge, in rank order, which is what merging by rank does. Texts are cut where the
pattern must cut (a run of non-space with at most one space before it, or a run of
space); each distinct piece is encoded once per task and looked up from
then on, long pieces (texts without spaces are one) each time they come. Only the lookup table, about ``cache`` pieces of 64
characters at most, and one Arrow batch are in memory, there is no shuffle, and a lost task is simply run again.

Decoding maps ids to the characters of the table and back to bytes; characters whose bytes
are split over tokens come together because whole byte runs are joined before UTF-8 is read.

Defined results: null and empty texts give no ids, zero tokens and the hashes of the empty
string; repeated rows and null ids pass through row by row; an empty table gives an empty
result; other columns are not read unless named in ``carry``.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.llm.pieces import PieceIds
from intakeyard.session import ship_package

#: White space of the pattern's ``\s`` (Unicode White_Space).
SPACE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_characters() -> list[str]:
    """Printable stand-in for each byte: itself where printable in Latin-1, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file; made once per Python worker."""

    def __init__(self, ranks_path: str, pattern: str, cache: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, chars = read_ranks(ranks_path), byte_characters()
        show = {t: "".join(chars[b] for b in t) for t in ranks}
        merges = [(show[t[:i]], show[t[i:]]) for t, r in sorted(ranks.items(), key=lambda x: x[1])
                  for i in range(1, len(t)) if ranks.get(t[:i], r) < r and ranks.get(t[i:], r) < r]
        self.model = Tokenizer(models.BPE(vocab={show[t]: r for t, r in ranks.items()}, merges=merges,
                                          ignore_merges=True, cache_capacity=0))
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        byte_of = {c: b for b, c in enumerate(chars)}
        back = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            back[r] = bytes(byte_of[c] for c in show[t])  # the byte table, reversed
        self.token_bytes = pa.array(back, pa.large_binary())
        self.token_text = pa.array([f"{i}," for i in range(len(back))], pa.large_string())
        self.pieces = PieceIds(lambda p: [e.ids for e in self.model.encode_batch_fast(p, add_special_tokens=False)], cache)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one run, and the token count of each text."""
        pieces = [PIECES.findall(t) for t in texts]
        ids, per_piece = self.pieces.of([p for row in pieces for p in row])
        ends = np.concatenate([[0], np.cumsum(per_piece)])
        return ids, np.diff(ends[np.cumsum([0] + [len(row) for row in pieces])])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; ``.decode()`` of the whole gives the text, split characters included."""
        return _joined(self.token_bytes.take(pa.array(ids)))

    def decimal(self, ids: np.ndarray) -> bytes:
        return _joined(self.token_text.take(pa.array(ids)))[:-1]

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character start and end of each token (a split character belongs to every token that holds a byte of it)."""
        data = np.frombuffer(self.decode(ids), np.uint8)
        char_at = np.concatenate([np.cumsum((data & 0xC0) != 0x80) - 1, [np.count_nonzero((data & 0xC0) != 0x80)]])
        size = np.diff(_offsets(self.token_bytes.take(pa.array(ids))))
        end = np.cumsum(size)
        return char_at[end - size], char_at[end - 1] + 1


def _offsets(a: pa.Array) -> np.ndarray:
    return np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]


def _joined(a: pa.Array) -> bytes:
    if len(a) == 0:
        return b""
    off = _offsets(a)
    return a.buffers()[2].slice(int(off[0]), int(off[-1] - off[0])).to_pybytes()


_CODECS: dict[tuple, Codec] = {}


def codec(ranks_path: str, pattern: str, cache: int) -> Codec:
    key = (ranks_path, pattern, cache)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def byte_bpe(docs: DataFrame, ranks_path: str, pattern: str, *, text_col: str = "text", carry: list[str] | None = None,
             with_ids: bool = False, cache: int = 100_000) -> DataFrame:
    """Encode and decode every text; keeps the ``carry`` columns (all but none by default) and adds
    ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked, ``ids``, ``char_starts``, ``char_ends``.

    Added names win over carried ones of the same name.
    """
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
             T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        added += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("ids", "char_starts", "char_ends")]
    names = {f.name.lower() for f in added}
    carried = [c for c in carry or [] if c.lower() not in names]
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__text"))
    schema = T.StructType([source.schema[c] for c in carried] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern, cache)
        for big in batches:
            for start in range(0, big.num_rows, 128):
                batch = big.slice(start, 128)
                texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
                ids, counts = c.encode(texts)
                rows = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
                cols = [batch.column(i) for i in range(len(carried))]
                cols += [pa.array(counts, pa.int64()),
                         pa.array([hashlib.sha256(c.decimal(r)).hexdigest() for r in rows], pa.string()),
                         pa.array([hashlib.sha256(c.decode(r)).hexdigest() for r in rows], pa.string())]
                if with_ids:
                    spans = [c.offsets(r) for r in rows]
                    for values in (rows, [s for s, _ in spans], [e for _, e in spans]):
                        cols.append(pa.array([v.astype(np.int32) for v in values], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def op5_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from intakeyard.llm.common import documents

    return byte_bpe(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                    public_tokenizers.PATTERN, carry=["doc_id"])
