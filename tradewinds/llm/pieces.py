"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they make, the leftmost
of equals first. The best pair is merged, the pairs on both sides of the new symbol enter the agenda, and
entries whose symbols have changed since are passed over, so a text of n characters takes n log n steps.
User-defined symbols are never merged, unused pieces are taken apart again, and characters without a piece
become bytes (or the unknown id, one for a run of them).

Two symbols can only ever merge if some piece has their characters side by side. So a text is cut, before
the agenda, wherever no piece has the two bytes on both sides next to each other. With common vocabularies
that leaves words; the ids of those met before come from a table of bounded size in each Python worker
(`wordtable`). New words of ASCII characters that are pieces are merged many at once (`merges`, the same
order of merges); the agenda sees the other new ones.

Texts come and go in Arrow batches. With `check` each batch is also encoded and decoded by the sentencepiece
library, and `agrees` tells where both have the same ids and text.

Defined cases: a null or empty text has no ids and decodes to the empty text; a null doc_id is kept; rows
that repeat are encoded each; very long texts are taken whole; other columns are ignored; an empty table
gives an empty result. A model that is not of the merge type, or does not mark spaces ahead of words, is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents
from tradewinds.llm.merges import LONGEST, PairTable, merged
from tradewinds.llm.text import Words
from tradewinds.llm.wordtable import WordTable

BLOCK_BYTES = 500_000
_SPACE = "▁"
#: Lengths of words that are merged in one call.
_BANDS = ((0, 7), (7, 12), (12, LONGEST))
_SCHEMA = "doc_id bigint, ids array<int>, decoded string, agrees boolean"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)  # fixed values of the model file

_known: dict[str, Pieces] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary with its agenda; a space stands for the mark of spaces in pieces."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_proto=model)
        self.model = sentencepiece_model_pb2.ModelProto.FromString(model)
        trainer, normalizer = self.model.trainer_spec, self.model.normalizer_spec
        if trainer.model_type != trainer.BPE:
            raise ValueError("not a model of the merge type")
        if not normalizer.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("a model that does not mark spaces, or marks them behind words")
        self.identity = not normalizer.precompiled_charsmap and not normalizer.remove_extra_whitespaces
        self.prefix = " " if normalizer.add_dummy_prefix else ""
        self.rank, self.unused, self.id, self.bytes, self.unknown = {}, set(), {}, {}, 0
        self.text: list[bytes] = []
        own, reserved, user = {}, {}, []
        joins = np.zeros((256, 256), bool)
        for k, piece in enumerate(self.model.pieces):
            form = piece.piece.replace(_SPACE, " ")
            data = form.encode("utf-8")
            if piece.type in (_NORMAL, _USER, _UNUSED):
                own[form] = k
                self.rank[form] = -piece.score
                codes = np.frombuffer(data, np.uint8)
                joins[codes[:-1], codes[1:]] = True
                if piece.type == _UNUSED:
                    self.unused.add(form)
                elif piece.type == _USER:
                    user.append(form)
            else:
                reserved[form] = k
            if piece.type == _BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes[value] = k
                data = bytes([value])
            elif piece.type == _UNKNOWN:
                self.unknown, data = k, trainer.unk_surface.encode("utf-8")
            elif piece.type == _CONTROL:
                data = b""
            self.text.append(data)
        self.id = own | reserved
        self.letters = np.full(256, -1, np.int32)
        # Symbols of the user and unused pieces are for the agenda alone.
        self.pairs = None if user or self.unused or own.keys() & reserved.keys() else self._pairs(own)
        joins[:, 0x80:0xC0] = True  # never within a character
        self.cut = ~joins
        self.user = re.compile("|".join(map(re.escape, sorted(user, key=len, reverse=True)))) if user else None
        self.fallback = trainer.byte_fallback
        self.table = WordTable(self._learn)

    def _pairs(self, own: dict[str, int]) -> PairTable | None:
        """All pairs of pieces that make a piece; pairs of equal score are equals. Fills `letters`."""
        for form, k in own.items():
            if len(form) == 1 and form < "\x80":
                self.letters[ord(form)] = k
        found = [
            (self.rank[form], own[form[:i]], own[form[i:]], k)
            for form, k in own.items() for i in range(1, len(form)) if form[:i] in own and form[i:] in own
        ]
        if not found:
            return None
        scores, left, right, products = map(np.array, zip(*found))
        return PairTable(np.stack([left, right], 1), products, np.unique(scores, return_inverse=True)[1])

    def _symbols(self, text: str) -> tuple[list[str], set[int]]:
        """Characters and user-defined symbols, and the positions of the latter."""
        if self.user is None:
            return list(text), set()
        symbols, fixed, at = [], set(), 0
        for found in self.user.finditer(text):
            symbols += text[at:found.start()]
            fixed.add(len(symbols))
            symbols.append(found.group())
            at = found.end()
        return symbols + list(text[at:]), fixed

    def agenda(self, text: str) -> list[str]:
        """The pieces that are left of a text (with spaces for their mark) when no pair can be merged."""
        symbols, fixed = self._symbols(text)
        rank, apart = self.rank, {}
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def entry(left: int, right: int) -> tuple | None:
            form = symbols[left] + symbols[right]
            if form not in rank or left in fixed or right in fixed:
                return None
            if form in self.unused:
                apart[form] = symbols[left], symbols[right]
            return rank[form], left, right, form

        waiting = [e for k in range(n - 1) if (e := entry(k, k + 1))]
        heapify(waiting)
        while waiting:
            _, left, right, form = heappop(waiting)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(form):
                continue
            symbols[left], symbols[right] = form, ""
            beyond = after[left] = after[right]
            if beyond < n:
                before[beyond] = left
                if e := entry(left, beyond):
                    heappush(waiting, e)
            if before[left] >= 0 and (e := entry(before[left], left)):
                heappush(waiting, e)
        whole = [s for s in symbols if s]
        return self._apart(whole, apart) if apart else whole

    def _apart(self, pieces: list[str], parts: dict) -> list[str]:
        """Unused pieces replaced by the two that made them, as often as needed."""
        out, waiting = [], pieces[::-1]
        while waiting:
            piece = waiting.pop()
            if piece in self.unused and piece in parts:
                waiting += reversed(parts[piece])
            else:
                out.append(piece)
        return out

    def _ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            found = self.id.get(piece, self.unknown)
            if found != self.unknown or not self.fallback:
                out.append(found)
            else:
                # In a piece a space stands for the three bytes of its mark.
                out += [self.bytes[b] for b in piece.replace(" ", _SPACE).encode("utf-8")]
        return out

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        lengths, others = ends - starts, np.ones(len(starts), bool)
        if self.pairs is not None:
            total = np.concatenate([[0], np.cumsum(self.letters[data] < 0)])
            others = (total[ends] > total[starts]) | (lengths > LONGEST)
            for low, n in _BANDS:
                some = np.flatnonzero(~others & (lengths > low) & (lengths <= n))
                if len(some):
                    # What lies beyond a word's end is not used.
                    at = np.minimum(starts[some][:, None] + np.arange(n), len(data) - 1)
                    symbols = self.letters[data[at]]
                    ids, counts = merged(self.pairs, symbols, lengths[some])
                    yield some, ids.astype(np.uint32), counts
        rest = np.flatnonzero(others)
        found = [
            self._ids(self.agenda(data[i:j].tobytes().decode("utf-8")))
            for i, j in zip(starts[rest].tolist(), ends[rest].tolist())
        ]
        counts = np.array([len(x) for x in found], np.int64)
        yield rest, np.array([k for x in found for k in x], np.uint32), counts

    def _normal(self, text: str) -> bytes:
        if not text:
            return b""
        whole = self.prefix + text if self.identity else self.library.normalize(text)
        return whole.replace(_SPACE, " ").encode("utf-8")

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of every text."""
        block, size = [], 0
        for text in texts:
            block.append(self._normal(text))
            size += len(block[-1])
            if size >= BLOCK_BYTES:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, block: list[bytes]) -> Iterator[np.ndarray]:
        data = np.frombuffer(b"".join(block), np.uint8)
        borders = np.cumsum([0, *map(len, block)])
        begin = np.ones(len(data) + 1, bool)
        if len(data) and self.user is None:
            begin[1:-1] = self.cut[data[:-1], data[1:]]
        elif len(data):
            begin[1:-1] = False  # a symbol of the user may stand across any cut
        begin[borders] = True
        at = np.flatnonzero(begin)
        starts, ends = at[:-1], at[1:]
        ids, counts = self.table.look_up(Words(data, starts, ends).hashes(), data, starts, ends)
        before = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, borders)]
        for i, j in zip(before.tolist(), before[1:].tolist()):
            own = ids[i:j]
            if not self.fallback and len(own):
                # A run of unknown characters is one unknown piece.
                own = own[np.append(True, (own[1:] != self.unknown) | (own[:-1] != self.unknown))]
            yield own

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no character become U+FFFD each."""
        data = b"".join(map(self.text.__getitem__, ids))
        if self.prefix and data[:1] == b" " and ids[0] not in (self.unknown, self.bytes.get(32)):
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            out, at = [], 0
            while at < len(data):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(data[at:at + n].decode("utf-8"))
                    except UnicodeDecodeError:
                        continue
                    at += n
                    break
                else:
                    out.append("�")
                    at += 1
            return "".join(out)


def pieces(path: str | None) -> Pieces:
    """The vocabulary of a model file, read once a worker."""
    path = path or default_model()
    if path not in _known:
        with open(path, "rb") as file:
            _known[path] = Pieces(file.read())
    return _known[path]


def _encoding(path: str | None, check: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = list(vocabulary.encode(texts))
            lists = [x.tolist() for x in found]
            decoded = list(map(vocabulary.decode, lists))
            agrees = None
            if check:
                library = vocabulary.library.encode(texts, out_type=int, num_threads=1)
                again = vocabulary.library.decode(lists, num_threads=1) if lists else []
                agrees = [a == b and c == d for a, b, c, d in zip(lists, library, decoded, again)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate([*found, np.empty(0, np.uint32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(decoded, pa.string()), pa.array(agrees or [None] * len(texts), pa.bool_()),
                ],
                names=["doc_id", "ids", "decoded", "agrees"],
            )

    return encode


def encode(docs: DataFrame, model: str | None = None, check: bool = True) -> DataFrame:
    """doc_id, ids, decoded (the text of these ids) and agrees for every row.

    `model` is the path of a sentencepiece file on every executor. Without `check`, `agrees` is null.
    """
    return documents(docs).mapInArrow(_encoding(model, check), _SCHEMA)


def digest(encoded: DataFrame) -> DataFrame:
    """The number of ids, and digests of ids and decoded text, in place of these."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees",
    )
