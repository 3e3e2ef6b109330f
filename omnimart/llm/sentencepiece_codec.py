"""SentencePiece models run by the tokenizers library.

The model file's protobuf is parsed here. Its pieces and scores become a Unigram model, or a BPE model
whose merges are every split of a piece into two pieces, best score first; byte
pieces become the byte fallback, and the normaliser specification becomes normalisers: the
compiled character map if there is one, blanks stripped and joined if asked for, the marker for blanks
(U+2581), and the dummy prefix.

If the normaliser keeps the text as it is and no piece reaches across a blank from the left, a text is
encoded by its distinct chunks (``chunks``), in multithreaded batches; else as a whole. With ``parity``
every newly encoded chunk is compared with the sentencepiece library, and a difference is an error.

Null and empty texts have no ids and decode to the empty text. Rows with equal ids or texts are encoded each;
extra columns pass through, and a clash with a result column is an error. A text's own
U+2581 is a blank to the model and comes back as one.
"""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from omnimart.llm import textops
from omnimart.llm.chunks import ChunkEncoder
from omnimart.llm.frames import map_batches

MARK = "▁"
#: Remembered chunks of a task, whose worker also holds both libraries' models.
KEPT = 400_000
#: Numbers of the protobuf's enumerations, fixed by the format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """Number and value of each field of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    join_blanks: bool = True

    @classmethod
    def read(cls, path: str) -> Model:
        model = cls()
        with open(path, "rb") as file:
            data = file.read()
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                model.pieces.append(own.get(1, b"").decode())
                model.scores.append(own.get(2, 0.0))
                model.types.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(_fields(value))
                model.kind = own.get(3, UNIGRAM)
                model.suffix = bool(own.get(24, 0))
                model.byte_fallback = bool(own.get(35, 0))
            elif number == 3:
                own = dict(_fields(value))
                model.char_map = own.get(2, b"")
                model.dummy_prefix = bool(own.get(3, 1))
                model.join_blanks = bool(own.get(4, 1))
        if model.kind not in (UNIGRAM, BPE) or model.suffix or {USER_DEFINED, UNUSED} & set(model.types):
            raise ValueError("only unigram and BPE models with blanks before words and without user-defined or unused pieces")
        return model

    def by_chunks(self) -> bool:
        """Whether a text's ids are those of its chunks, each from a blank to before the next."""
        return not self.char_map and not self.join_blanks and not any(MARK in p.lstrip(MARK) for p, t in zip(self.pieces, self.types) if t == NORMAL)

    def merges(self) -> list[tuple[str, str]]:
        """All splits of normal pieces into normal pieces, by falling score of the whole."""
        normal = {p for p, t in zip(self.pieces, self.types) if t == NORMAL}
        if not {c for p in normal for c in p} <= normal:
            raise ValueError("a piece has a character that is no piece")
        order = sorted((i for i, t in enumerate(self.types) if t == NORMAL and len(self.pieces[i]) > 1), key=lambda i: (-self.scores[i], i))
        found = []
        for i in order:
            p = self.pieces[i]
            found += [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        return found

    def tokenizer(self, whole: bool):
        """Tokenizer of the tokenizers library; ``whole``: for whole texts, else for chunks with their first blank."""
        from tokenizers import Regex, Tokenizer, models, normalizers

        unknown = self.types.index(UNKNOWN)
        if self.kind == BPE:
            model = models.BPE({p: i for i, p in enumerate(self.pieces)}, self.merges(), unk_token=self.pieces[unknown], fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            model = models.Unigram(list(zip(self.pieces, self.scores)), unknown, self.byte_fallback)
        found = Tokenizer(model)
        steps = []
        if whole:
            steps += [normalizers.Precompiled(self.char_map)] if self.char_map else []
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")] if self.join_blanks else []
            steps += [normalizers.Prepend(" ")] if self.dummy_prefix else []
        found.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        return found

    def surface(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that each id decodes to, joined, and their bounds."""
        found = []
        for piece, kind in zip(self.pieces, self.types):
            if kind == BYTE:
                found.append(bytes([int(piece[3:5], 16)]))
            else:
                found.append(b"" if kind in (CONTROL,) else " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode())
        return np.frombuffer(b"".join(found), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in found])])


def blank_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Blanks after something that is neither a blank nor the marker."""
    cuts = np.zeros(len(raw), dtype=bool)
    cuts[1:] = (raw[1:] == 32) & (raw[:-1] != 32)
    if len(raw) > 3:
        cuts[3:] &= ~((raw[2:-1] == 0x81) & (raw[1:-2] == 0x96) & (raw[:-3] == 0xE2))
    return cuts


def _encoder(path: str, threads: int, parity: bool) -> ChunkEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    model = Model.read(path)
    chunked = model.by_chunks()
    tokenizer = model.tokenizer(whole=not chunked)
    prefix = " " if chunked and model.dummy_prefix else ""
    reference = None
    if parity:
        import sentencepiece

        reference = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(chunks: list[str], at_head: np.ndarray) -> list[list[int]]:
        full = [prefix + c if head else c for c, head in zip(chunks, at_head)]
        ids = [e.ids for e in tokenizer.encode_batch_fast(full, add_special_tokens=False)]
        if reference is not None:
            # The library puts a blank before what it gets (unless that is empty), so a chunk's own first blank is taken off.
            bare = [c[len(prefix) :] if chunked else c for c in full]
            for text, whole, own, other in zip(bare, full, ids, reference.encode(bare, num_threads=threads)):
                if own != (other if text or not whole else [reference.piece_to_id(MARK)]):
                    raise ValueError(f"not the ids of the sentencepiece library: {text[:80]!r}")
        return ids

    def nowhere(raw, bounds):
        return np.zeros(len(raw), dtype=bool)

    if chunked and not model.dummy_prefix:
        chunked = False  # without the prefix a chunk in mid-text is not what the library would see alone
        prefix = ""
    return ChunkEncoder(blank_starts if chunked else nowhere, encode, mark_first=True, kept=KEPT)


class Surface:
    """Texts of ids."""

    def __init__(self, path: str):
        model = Model.read(path)
        self.flat, self.bounds = model.surface()
        self.size, self.drop = np.diff(self.bounds), int(model.dummy_prefix)

    def texts(self, ids: np.ndarray, cut: np.ndarray) -> list[str]:
        """Text of each row of ids, without the dummy prefix."""
        n = self.size[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        data = self.flat[np.repeat(self.bounds[ids] - (ends - n), n) + np.arange(total)].tobytes()
        edge = np.concatenate([[0], ends])[cut].tolist()
        return [data[i + (self.drop if data[i : i + 1] == b" " else 0) : j].decode("utf-8", "replace") for i, j in zip(edge[:-1], edge[1:])]


def encode(docs: DataFrame, path: str, threads: int = 2, parity: bool = True, back: bool = False) -> DataFrame:
    """``docs`` with token_ids, the ids of ``text``; with ``back`` also decoded, the text of these ids."""
    added = ["token_ids", "decoded"] if back else ["token_ids"]
    for name in added:
        if name in docs.columns:
            raise ValueError(f"the input has a column {name}")

    def run(batches):
        encoder, surface = _encoder(path, threads, parity), Surface(path) if back else None
        for batch in batches:
            for at, end, ids, cut, _, _ in encoder.pieces(batch["text"]):
                part = batch.slice(at, end - at)
                columns = [*part.columns, textops.lists(ids.astype(np.int32), cut)]
                if back:
                    columns.append(pa.array(surface.texts(ids, cut), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])

    kinds = {"token_ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
    return map_batches(docs, run, T.StructType([*docs.schema.fields, *(T.StructField(c, kinds[c]) for c in added)]))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with decoded, the text of ``token_ids`` (null for null)."""
    if "decoded" in rows.columns:
        raise ValueError("the input has a column decoded")

    def run(batches):
        surface = Surface(path)
        for batch in batches:
            lists = batch["token_ids"]
            ids = lists.flatten().to_numpy()
            cut = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            for first in range(0, batch.num_rows, 500):
                last = min(first + 500, batch.num_rows)
                texts = surface.texts(ids[cut[first] : cut[last]], cut[first : last + 1] - cut[first])
                part = batch.slice(first, last - first)
                column = pa.array(texts, pa.string(), mask=lists[first:last].is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*batch.schema.names, "decoded"])

    return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))
