"""SentencePiece encoding and decoding for merge-type models, by backtracking.

A merge model joins, again and again, the adjacent pair whose concatenation is the best-scored piece.
A sequence of pieces is that model's encoding exactly when every adjacent pair of them is: when
re-merging the two pieces' characters from scratch gives the same two pieces back. So the encoder
walks the text from the left, takes at each position the longest piece found by an Aho-Corasick
automaton, checks it against the piece before by re-merging (remembered per pair of pieces), tries
shorter pieces when the check fails, steps back when none is left, and marks in a bitfield the
positions from which the rest of the text can't be reached.

No piece of such a model holds a space mark after another character, so no merge crosses from one
space-delimited word into the next. More generally no merge crosses between two characters that
stand next to each other in no piece; a text is cut there, and the parts are encoded once and kept
in a bounded memory per worker.

Defined results: a null text counts as empty; an empty text has no pieces, hence only the end id if
one is asked for, and decodes to an empty text. Null ids pass through, repeated rows give repeated
results, order does not matter, an empty table gives an empty result, other columns are ignored.
Texts of any length take memory in proportion to one Arrow batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .pretokens import Memory

MARK = "▁"
#: Distinct words, and parts of words, in each of the two generations that one worker keeps.
KEEP_WORDS = 200_000


class MergeCodec:
    """Encoder and decoder of one model file; results equal the sentencepiece library's."""

    def __init__(self, model_path: str) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        probe = "  A ÀﬁⅧ  b \t"
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("only models that keep text as it is, after a leading space, are supported")
        self.size, self.end_id, self.unk_id = sp.get_piece_size(), sp.eos_id(), sp.unk_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.byte_ids = [self.unk_id] * 256
        self.pieces: list[str] = []
        self.silent: set[int] = set()
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            self.pieces.append(piece)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[i] = value
                self.byte_ids[value] = i
            elif sp.is_control(i):
                self.silent.add(i)
            elif not sp.is_unknown(i):
                if sp.is_unused(i) or MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} is of a kind that is not supported")
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        #: Neighbours inside some piece; a text can be cut between all others.
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.whole: dict[str, bool] = {}
        self.prefix: dict[str, str] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The model's own procedure; quadratic, so for one or two pieces only."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def is_whole(self, piece: str) -> bool:
        """Merging the piece's characters gives the piece."""
        ok = self.whole.get(piece)
        if ok is None:
            ok = self.whole[piece] = self.merge(piece) == [piece]
        return ok

    def fits(self, left: str, right: str) -> bool:
        """Merging both pieces' characters gives the two pieces."""
        ok = self.pairs.get((left, right))
        if ok is None:
            if len(self.pairs) >= 2_000_000:
                self.pairs.clear()
            ok = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return ok

    def longest(self, text: str, at: int) -> str:
        """The longest piece that starts at a position; a character that starts none stands for itself."""
        for end, length in self.automaton.iter_long(text, at):
            if end - length + 1 == at:
                return text[at : end + 1]
            break
        return text[at]

    def shorter(self, piece: str) -> str | None:
        """The longest piece that the piece begins with, down to its first character."""
        found = self.prefix.get(piece)
        if found is None:
            ids = self.ids
            found = next((piece[:k] for k in range(len(piece) - 1, 1, -1) if piece[:k] in ids), piece[:1] if len(piece) > 1 else "")
            self.prefix[piece] = found
        return found or None

    def split(self, text: str) -> list[str]:
        """The pieces of a text that is already marked (spaces replaced)."""
        n = len(text)
        if n < 2:
            return [text] if n else []
        failed = bytearray((n >> 3) + 1)
        whole, pairs, prefix = self.whole, self.pairs, self.prefix
        out: list[str] = []
        at, last = 0, None
        piece: str | None = self.longest(text, 0)
        while True:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (whole.get(piece) or self.is_whole(piece)):
                    if last is None:
                        break
                    ok = pairs.get((last, piece))
                    if ok or ok is None and self.fits(last, piece):
                        break
                piece = prefix.get(piece) or self.shorter(piece)
            if piece is not None:
                out.append(piece)
                at, last = end, piece
                if at == n:
                    return out
                piece = self.longest(text, at)
            else:
                if not out:
                    raise AssertionError("no sequence of pieces fits the text")
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
                piece = self.shorter(piece)

    def encode_marked(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.split(text):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            else:  # one character that no piece stands for
                out.extend(self.byte_ids[b] for b in piece.encode())
        return out

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without the end id."""
        return [i for part in self.parts(text) for i in self.encode_marked(part)]

    def parts(self, text: str) -> Iterable[str]:
        if not text:
            return
        for word in self.words(text):
            yield from self.cut_up(MARK + word)

    @staticmethod
    def words(text: str) -> list[str]:
        """Parts that no merge crosses, each without the space mark it begins with."""
        found = text.split(" ")
        if MARK in text or "" in found:
            found = [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
        return found

    def cut_up(self, marked: str) -> list[str]:
        joined = self.joined
        cuts = [k for k in range(1, len(marked)) if marked[k - 1 : k + 1] not in joined]
        if not cuts:
            return [marked]
        return [marked[i:k] for i, k in zip([0, *cuts], [*cuts, len(marked)], strict=True)]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids: control ids are silent, byte ids join into UTF-8, one leading space goes."""
        return self.join(ids)[1:] if (ids := list(ids)) and self.join(ids)[:1] == " " else self.join(ids)

    def join(self, ids: Iterable[int]) -> str:
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            b = self.bytes.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if i not in self.silent:
                out.append(self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")


Known = tuple[str, int, str]  # ids as text, number of ids, decoded text


class WordMemory(Memory):
    """Words without their space mark, put together from the parts that no merge crosses."""

    def __init__(self, codec: MergeCodec, keep: int) -> None:
        super().__init__(self.compose, keep)
        self.codec = codec
        self.parts = Memory(self.encode_part, keep)

    def encode_part(self, part: str) -> Known:
        ids = self.codec.encode_marked(part)
        return " ".join(map(str, ids)), len(ids), self.codec.join(ids)

    def compose(self, word: str) -> Known:
        found = [self.parts[p] for p in self.codec.cut_up(MARK + word)]
        if len(found) == 1:
            return found[0]
        return " ".join([f[0] for f in found]), sum([f[1] for f in found]), "".join([f[2] for f in found])


_memories: dict[tuple[str, int], WordMemory] = {}


def memory(model_path: str, keep: int = KEEP_WORDS) -> WordMemory:
    """One per worker process, model and size; lost with the process and then simply built again."""
    if (model_path, keep) not in _memories:
        _memories[model_path, keep] = WordMemory(MergeCodec(model_path), keep)
    return _memories[model_path, keep]


def encode_texts(
    docs: DataFrame,
    model_path: str,
    text_column: str = "text",
    add_end: bool = True,
    carry: tuple[str, ...] = ("doc_id",),
    keep: int = KEEP_WORDS,
) -> DataFrame:
    """``carry`` columns, then ``ids`` (array of int), ``n_tokens`` and the text that the ids decode to.

    ``keep``: words, and parts of words, that a worker remembers in each of two generations.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = memory(model_path, keep)
        tail = [str(known.codec.end_id)] if add_end else []
        ids, ends, texts = [], [0], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            found = list(map(known.__getitem__, MergeCodec.words(text))) if text else []
            row = np.fromstring(" ".join([f[0] for f in found] + tail), np.int32, sep=" ")
            ids.append(row)
            ends.append(ends[-1] + len(row))
            texts.append("".join([f[2] for f in found])[1:])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        counts = pa.array(np.diff(ends), pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, counts, pa.array(texts, pa.string())], names=[*carry, "ids", "n_tokens", "decoded"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return common.map_rows(docs.select(*carry, docs[text_column].cast("string").alias("__text")), one, f"{kinds}, ids array<int>, n_tokens long, decoded string")


def decode_ids(rows: DataFrame, model_path: str, ids_column: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``decoded``, the text of the ids; null ids decode to an empty text."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = memory(model_path).codec
        texts = [codec.decode(ids or ()) for ids in batch.column(batch.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*carry, "decoded"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    return common.map_rows(rows.select(*carry, F.col(ids_column).alias("__ids")), one, f"{kinds}, decoded string")


def digest_texts(docs: DataFrame, model_path: str, text_column: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``n_tokens`` with the end id, and digests of ids and of the decoded text.

    The same encoding as :func:`encode_texts`; the ids are joined word by word in their decimal
    form, so a long text never becomes a list of numbers.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = memory(model_path)
        end = str(known.codec.end_id)
        counts, id_sums, text_sums = [], [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            found = list(map(known.__getitem__, MergeCodec.words(text))) if text else []
            ids = [f[0] for f in found]
            ids.append(end)
            counts.append(sum([f[1] for f in found]) + 1)
            id_sums.append(hashlib.sha256(" ".join(ids).encode()).hexdigest())
            text_sums.append(hashlib.sha256("".join([f[2] for f in found])[1:].encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())],
            names=[*carry, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return common.map_rows(docs.select(*carry, docs[text_column].cast("string").alias("__text")), one, f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_texts(common.table(spark, sf_dir, "documents"), default_model())
