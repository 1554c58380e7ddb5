"""Byte-level BPE through a sentencepiece model written from the ranks.

A rank file lists byte strings in merge order. ``model_bytes`` writes each as
one sentencepiece BPE piece: its bytes mapped to printable characters, its
score the negative rank, its id the rank. sentencepiece merges the adjacent
pair whose concatenation has the highest score (the leftmost on ties), which is
the rule of the rank file. Normalisation is the identity: no dummy prefix, no
white-space handling, no character map.

A text is cut by ``pattern`` and every match is encoded on its own; decoding
maps ids to pieces and the pieces' characters back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from clickloom.llm.textops import map_batches, texts_of

#: distinct matches a worker remembers (its memory is emptied beyond that), and
#: the characters of text whose new matches are encoded in one call
MEMO = 300_000
RUN_CHARS = 2 << 20

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """One printable, non-space character for each byte: printable Latin-1
    bytes stand for themselves, the others move to U+0100 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The rank file's byte strings in rank order."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def model_bytes(ranks: list[bytes]) -> bytes:
    """The serialised sentencepiece model; piece ids equal ranks."""
    chars = byte_characters()
    model = model_pb2.ModelProto()
    for rank, piece in enumerate(ranks):
        entry = model.pieces.add()
        entry.piece = "".join(chars[b] for b in piece)
        entry.score = -float(rank)
        entry.type = model_pb2.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score = "⁇", -float(len(ranks))
    unknown.type = model_pb2.ModelProto.SentencePiece.UNKNOWN
    trainer, norm = model.trainer_spec, model.normalizer_spec
    trainer.model_type = model_pb2.TrainerSpec.BPE
    trainer.vocab_size = len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(ranks), -1, -1, -1
    trainer.unk_piece = unknown.piece
    trainer.treat_whitespace_as_suffix = False
    norm.name = "identity"
    norm.precompiled_charsmap = b""
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder over one serialised model."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        # \s as Unicode's White_Space property, in and outside brackets
        self.find = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
        self.chars = byte_characters()
        self.to_chars = {b: c for b, c in enumerate(self.chars)}
        back = {c: b for b, c in enumerate(self.chars)}
        self.bytes_of = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(self.sp.get_piece_size() - 1)]
        self.memo: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        mapped = [m.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.to_chars) for m in new]
        for match, ids in zip(new, self.sp.encode(mapped, out_type=int, num_threads=1), strict=True):
            self.memo[match] = array("I", ids).tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers.

        Matches not met before are encoded in one call for a run of texts."""
        at = 0
        while at < len(texts):
            found, size = [], 0
            while at < len(texts) and (not found or size < RUN_CHARS):
                found.append(self.find(texts[at]))
                size += len(texts[at])
                at += 1
            if len(self.memo) > MEMO:
                self.memo.clear()
            memo = self.memo
            self._learn(list({m for matches in found for m in matches if m not in memo}))
            for matches in found:
                yield b"".join(map(memo.__getitem__, matches))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


_LOADED: dict[str, ByteBpe] = {}


def _loaded(model: bytes, pattern: str) -> ByteBpe:
    """One processor a worker, whatever the number of its tasks."""
    key = hashlib.sha256(model).hexdigest() + pattern
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(model, pattern)
    return _LOADED[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>``: every whole text by the ranks at path
    ``vocabulary``. A null text is empty, an empty text has no ids; repeated
    rows give repeated rows."""
    model = model_bytes(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model, pattern)
        for b in batches:
            ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in bpe.encode_all(texts_of(b))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The inverse of ``encode_documents``: ``doc_id, text_bytes binary``."""
    model = model_bytes(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model, pattern)
        for b in batches:
            out = [bpe.decode(np.array(i or [], "<u4").tobytes()) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "text_bytes"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text_bytes binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode and decode every text in one pass and return the digests of both.

    Null and empty texts have 0 tokens and the digests of no bytes; repeated
    rows give a row each; an empty table gives no rows; other columns are not
    read."""
    model = model_bytes(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model, pattern)
        for b in batches:
            count, ids_hash, text_hash = [], [], []
            for ids in bpe.encode_all(texts_of(b)):
                count.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()),
                 pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)
