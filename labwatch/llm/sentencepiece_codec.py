"""SentencePiece models on the tokenizers library.

The model file is parsed from its wire format and rebuilt: precompiled
character map, whitespace rules, the dummy prefix and the metaspace marker,
unigram scores or the merges that a BPE model's scores imply, and byte
fallback. Batches of whole texts are encoded multithreaded, and the
sentencepiece library proves each text: it must give the same ids, and must get
the text back from them.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import lean, pieces, table, texts

BATCH_BYTES = 1 << 20
MARK = "▁"
#: Piece types and model types of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def model_bytes(spark, path: str) -> bytes:
    """A model file's bytes, half a megabyte: from the installed tokenizers or from any store Spark reads."""
    if os.path.exists(path):
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(field number, value)`` of one protobuf message: integers for varints, raw bytes otherwise."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind} is not used by model files")
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            got = dict(fields(value))
            model.kind, model.byte_fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
            model.suffix, model.unk_id = bool(got.get(24, 0)), got.get(40, 0)
        elif number == 3:
            got = dict(fields(value))
            model.charsmap = got.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = (bool(got.get(n, 1)) for n in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE) or model.suffix:
        raise ValueError("only unigram and BPE models with the marker before words")
    return model


def merges(vocab: dict[str, int]) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best piece first (ids follow the scores)."""
    found = []
    for piece, rank in vocab.items():
        for cut in range(1, len(piece)):
            left, right = vocab.get(piece[:cut]), vocab.get(piece[cut:])
            if left is not None and right is not None:
                found.append((rank, left, right, piece[:cut], piece[cut:]))
    return [(left, right) for *_, left, right in sorted(found)]


class Codec:
    """Encodes and decodes with a rebuilt model; the sentencepiece library proves each text."""

    def __init__(self, data: bytes, threads: int = 2, verify: bool = True):
        # read once, when the library first starts its pool
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if threads > 1 else "false")
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        self.model = m = parse_model(data)
        names = [p for p, _, _ in m.pieces]
        if any(kind == USER_DEFINED for _, _, kind in m.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        if m.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
            order = sorted((i for i, (_, _, k) in enumerate(m.pieces) if k == NORMAL), key=lambda i: (-m.pieces[i][1], i))
            ranked = {names[i]: r for r, i in enumerate(order)}
            inner = models.BPE(vocab, merges(ranked), unk_token=names[m.unk_id], fuse_unk=True, byte_fallback=m.byte_fallback)
        else:
            inner = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=m.unk_id, byte_fallback=m.byte_fallback)
        self.tokenizer = Tokenizer(inner)
        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        out = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.tokenizer.decoder = decoders.Sequence([*out, decoders.Strip(" ", 1, 0)] if m.dummy_prefix else out)
        self.proof = None
        if verify:
            import sentencepiece

            self.proof = sentencepiece.SentencePieceProcessor(model_proto=data)

    def normalize(self, text: str) -> str:
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape else text

    def encode(self, batch: list[str]) -> list[list[int]]:
        """The ids of each text; the library shares a batch among its threads."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([self.normalize(t) for t in batch], add_special_tokens=False)]

    def parity(self, batch: list[str], ids: list[list[int]]) -> list[bool]:
        """Whether sentencepiece gives the very ids for each whole text."""
        return [own == mine for own, mine in zip(self.proof.encode(batch, num_threads=1), ids, strict=True)]

    def round_trips(self, batch: list[str], ids: list[list[int]]) -> list[bool]:
        """Whether sentencepiece gets each whole text back from the ids."""
        return [back == t for back, t in zip(self.proof.decode(ids, num_threads=1), batch, strict=True)]

    def decode(self, batch: list[list[int]]) -> list[str]:
        """Texts from ids, by the rebuilt model alone."""
        return self.tokenizer.decode_batch(batch, skip_special_tokens=False)


def encode(docs: DataFrame, path: str, text: str = "text", threads: int = 2, verify: bool = True, place: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids array<int>``, ``n_tokens``, ``parity`` and ``round_trip`` beside ``doc_id``.

    ``parity``: the sentencepiece library gives the same ids for the whole
    text. ``round_trip``: it gets the whole text back from them; false for
    models whose normaliser changes the text, and for texts that hold the
    marker. Both are null if not verified. ``place`` names a long column that
    comes along as ``position``. Null texts count as empty: no ids.
    Repeated rows give repeated rows, an empty table none; other columns are
    not read. The work is narrow: batches are cut by bytes, and the model
    travels with the task.
    """
    data = model_bytes(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data, threads, verify)
        for batch in pieces(batches, BATCH_BYTES):
            rows = texts(batch.column(1))
            ids = codec.encode(rows)
            nothing = [None] * len(rows)
            same, back = (codec.parity(rows, ids), codec.round_trips(rows, ids)) if verify else (nothing, nothing)
            flat = [np.array(x, "<i4") for x in ids]
            offsets = np.cumsum([0, *map(len, ids)])
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0), "n_tokens": pa.array(np.diff(offsets), pa.int64()),
                    "token_ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(flat))),
                    "ids_sha256": pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in flat], pa.string()),
                    "parity": pa.array(same, pa.bool_()), "round_trip": pa.array(back, pa.bool_()),
                    **({"position": batch.column(2)} if place else {}),
                }
            )

    schema = "doc_id long, n_tokens long, token_ids array<int>, ids_sha256 string, parity boolean, round_trip boolean" + (", position long" if place else "")
    along = [F.col(place).cast("long").alias("position")] if place else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), *along).mapInArrow(lean(run), schema)


def decode(tokens: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``doc_id, text`` from ids; null ids give a null text."""
    data = model_bytes(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data, verify=False)
        for batch in pieces(batches, BATCH_BYTES):
            rows = batch.column(1).to_pylist()
            back = codec.decode([r or [] for r in rows])
            yield pa.record_batch({"doc_id": batch.column(0), "text": pa.array([b if r is not None else None for b, r in zip(back, rows, strict=True)], pa.string())})

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, id digests (little-endian 32-bit ids), parity and round trip of every document."""
    return encode(table(spark, sf_dir, "documents"), model_path()).drop("token_ids")
