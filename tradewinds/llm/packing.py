"""Documents packed into training sequences by bounded-space best fit.

Each task packs the documents of its own input partition as they come, so nothing is shuffled:

- a document's ids (and `END_ID`) fill whole sequences of `size` first;
- the rest goes to the open window that it fits best, or to a new one while fewer than `OPEN` are open;
- where none fits, the fullest window is filled up with the head of the rest and emitted.

So emitted sequences have no padding. What is left in open windows, less than `OPEN` * `size` ids a
task, is merged at the end: the tasks' leftovers are laid end to end (a running sum over one row per
task) and cut every `size` ids. The last stretch, shorter than `size`, is cut into powers of two.

The pieces are written once to shared storage, as sequence numbers come from the task; a lost task
writes its own pieces anew and a lost executor costs no others.

Tokens: the tokenizer's file comes as a parameter. Where its rules say that words can be cut apart (see
`_Tokenizer`), the ids of words met before come from a table of bounded size in each Python worker
(`wordtable`); with any other file every text goes through the tokenizer as a whole.

Defined cases: null or empty text is the one id `END_ID`; a null doc_id is packed as such; repeated
rows are packed each; very long texts are spread over many sequences; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, map_documents, new_path
from tradewinds.llm.merges import LONGEST, PairTable, merged
from tradewinds.llm.text import Words, begins, blocks, joined
from tradewinds.llm.wordtable import WordTable

SIZE = 4096
OPEN = 16
END_ID = 2
#: Texts are looked up together until they have so many bytes; the arrays for it take some 60 times as many.
BLOCK_BYTES = 500_000

_END = np.array([END_ID], np.uint32).tobytes()
_known: dict[str, _Tokenizer] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Of a byte: white space, letter (its case apart), digit, anything else of ASCII, or beyond.
_SPACE, _LETTER, _DIGIT, _OTHER, _BEYOND = range(5)
_KIND = np.full(256, _BEYOND, np.uint8)
_KIND[:128] = _OTHER
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: What a tokenizer's file says of its text where words can be cut apart and lowered ahead of it (fixed values).
_NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class _Tokenizer:
    """Ids of texts, word by word from a table where the tokenizer's file allows that, else text by text.

    By that file's rules a token never spans white space, nor a border between ASCII letters, digits and
    other characters, and every digit is a word of its own. Words with an apostrophe, a character beyond
    ASCII or the first character of an added token are left whole and as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        normalizer, splitter = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}
        split = (splitter.get("pretokenizers") or [{}])[0]
        added = [token["content"] for token in rules["added_tokens"]]
        self.by_word = (
            normalizer.get("normalizers") == _NORMALIZERS and splitter["type"] == "Sequence"
            and (split["type"], split["pattern"], split["behavior"], split["invert"]) == ("Split", {"Regex": _PATTERN}, "Removed", True)
            and [p["type"] for p in splitter["pretokenizers"][1:]] in ([], ["ByteLevel"])
            and not any(p.get("add_prefix_space") or p.get("use_regex") for p in splitter["pretokenizers"][1:])
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in rules["added_tokens"])
            and all(t and t[0].isascii() and not t[0].isalnum() and not any(map(str.isspace, t)) for t in added)
        )
        self.added = [t.encode("utf-8") for t in added]
        self.whole = np.zeros(256, bool)
        self.whole[128:] = self.whole[ord("'")] = True
        for token in self.added:
            self.whole[token[0]] = True
        self.pairs = self._merges(rules["model"]) if self.by_word else None
        self.table = WordTable(self._learn)
        self.border = self._one(b"0")

    def _one(self, word: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids, np.uint32)

    def _merges(self, model: dict) -> PairTable | None:
        """The merges for words of lower-case letters, if they are all that such a word's ids depend on."""
        plain = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "ignore_merges": False}
        vocab, suffix = model.get("vocab"), model.get("end_of_word_suffix") or ""
        letters = [chr(c) for c in range(97, 123)]
        if any(model.get(k) != v for k, v in plain.items()) or any(c not in vocab or c + suffix not in vocab for c in letters):
            return None
        self.inner = np.array([0] * 97 + [vocab[c] for c in letters], np.int32)
        self.last = np.array([0] * 97 + [vocab[c + suffix] for c in letters], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return PairTable(np.array([[vocab[a], vocab[b]] for a, b in merges]), np.array([vocab[a + b] for a, b in merges]))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids of words: of letters by merges, of others by many words in one call with a digit, one token, between them."""
        lengths = ends - starts
        others = np.ones(len(starts), bool)
        if self.pairs is not None:
            total = np.concatenate([[0], np.cumsum((data < 97) | (data > 122))])
            others = (total[ends] > total[starts]) | (lengths > LONGEST)
            for n in range(1, LONGEST + 1):
                some = np.flatnonzero(~others & (lengths == n))
                if len(some):
                    letters = data[starts[some][:, None] + np.arange(n)]
                    symbols = self.inner[letters]
                    symbols[:, -1] = self.last[letters[:, -1]]
                    ids, counts = merged(self.pairs, symbols, lengths[some])
                    yield some, ids.astype(np.uint32), counts
        positions = np.flatnonzero(others).tolist()
        words = {k: data[starts[k]:ends[k]].tobytes() for k in positions}
        plain, odd = [], []
        for k, word in words.items():
            (odd if b"0" in word or any(t in word for t in self.added) else plain).append(k)
        for first in range(0, len(plain), 2_000):
            some = plain[first:first + 2_000]
            text = b" 0 ".join([words[k] for k in some]).decode("utf-8")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            borders = np.flatnonzero(ids == self.border[0])
            if len(self.border) != 1 or len(borders) != len(some) - 1:
                odd += some
                continue
            counts = np.diff(borders, prepend=-1, append=len(ids)) - 1
            yield np.array(some), np.delete(ids, borders), counts
        for first in range(0, len(odd), 2_000):
            some = odd[first:first + 2_000]
            found = [self._one(words[k]) for k in some]
            yield np.array(some), np.concatenate(found), np.array(list(map(len, found)))

    def _words(self, block: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' bytes, in lower case where that is free, and where the words in them begin and end."""
        data = joined(block)
        kind = _KIND[data]
        inside = kind != _SPACE
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
        starts = np.flatnonzero(edge == 1)
        # The last byte is white space, so that every run of others ends.
        lengths = np.flatnonzero(edge == -1) - starts
        total = np.concatenate([[0], np.cumsum(self.whole[data])])
        left = total[starts + lengths] > total[starts]
        whole = np.zeros(len(data), bool)
        whole[inside] = np.repeat(left, lengths)
        cut = np.empty(len(data), bool)
        cut[0] = True
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begin = (edge == 1) | (inside & ~whole & cut)
        ends = np.append(begin[1:], True) | ~np.append(inside[1:], False)
        return np.where(whole, data, _LOWER[data]), np.flatnonzero(begin), np.flatnonzero(ends & inside) + 1

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        if not self.by_word:
            for text in texts:
                found = self.tokenizer.encode_batch_fast([text or ""], add_special_tokens=False)
                yield np.array(found[0].ids, np.uint32).tobytes()
            return
        for _, block in blocks(texts, BLOCK_BYTES):
            data, starts, ends = self._words(block)
            words = Words(data, starts, ends)
            ids, counts = self.table.look_up(words.hashes(), data, starts, ends)
            before = np.concatenate([[0], np.cumsum(counts)])[begins(block, starts)]
            for i, j in zip(before.tolist(), before[1:].tolist()):
                yield ids[i:j].tobytes()


def token_ids(texts: list[str | None], path: str | None) -> Iterator[bytes]:
    """The ids of every text as little-endian unsigned 32-bit values, without special tokens."""
    path = path or default_tokenizer()
    if path not in _known:
        _known[path] = _Tokenizer(path)
    return _known[path].ids(texts)


class _Packer:
    def __init__(self, first: int, size: int, open_: int) -> None:
        self.next, self.size, self.open = first, size, open_
        self.windows: dict[int, list] = {}  # number: [ids so far, rows]
        self.rows: list[tuple] = []  # of emitted windows

    def add(self, doc_id, ids: bytes) -> None:
        total = len(ids) // 4

        def put(number: int, start: int, length: int) -> None:
            window = self.windows.setdefault(number, [0, []])
            window[1].append((doc_id, start, length, ids[4 * start:4 * (start + length)], total, number, window[0]))
            window[0] += length
            if window[0] == self.size:
                self.rows += self.windows.pop(number)[1]

        start = 0
        while total - start >= self.size:
            put(self._new(), start, self.size)
            start += self.size
        while start < total:
            rest = total - start
            fits = [(self.size - used, number) for number, (used, _) in self.windows.items() if used + rest <= self.size]
            if fits:
                put(min(fits)[1], start, rest)
                return
            if len(self.windows) < self.open:
                put(self._new(), start, rest)
                return
            used, number = max((used, -number) for number, (used, _) in self.windows.items())
            put(-number, start, self.size - used)
            start += self.size - used

    def _new(self) -> int:
        self.next += 1
        return self.next - 1


def _packing(path: str | None, size: int, open_: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        packer = _Packer(task << 32, size, open_)

        def frame(rows: list[tuple], left: list[int | None]) -> pd.DataFrame:
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            out = pd.DataFrame(rows, columns=names)
            return out.assign(task=task, position=pd.array(left, dtype="Int64"))

        for batch in batches:
            ids = list(batch["doc_id"])
            texts = list(batch["text"])
            for doc_id, tokens in zip(ids, token_ids(texts, path)):
                packer.add(doc_id, tokens + _END)
                if len(packer.rows) > 2_000:
                    yield frame(packer.rows, [None] * len(packer.rows))
                    packer.rows = []
            yield frame(packer.rows, [None] * len(packer.rows))
            packer.rows = []
        rows, left, at = [], [], 0
        for used, own in sorted(packer.windows.values(), key=lambda w: -w[0]):
            rows += own
            left += [at + row[-1] for row in own]
            at += used
        yield frame(rows, left)

    return pack


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, open_windows: int = OPEN) -> DataFrame:
    """A row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    `ids` holds the piece's ids as little-endian unsigned 32-bit values. `tokenizer` is the path of a
    tokenizers file on every executor; by default the installed word-level byte-pair one.
    """
    spark = docs.sparkSession
    columns = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    written = new_path(spark, "pieces")
    (
        map_documents(documents(docs), _packing(tokenizer, size, open_windows), f"{columns}, task bigint, position bigint")
        .write.option("compression", "zstd").parquet(written)
    )
    pieces = spark.read.schema(f"{columns}, task bigint, position bigint").parquet(written)
    names = [c.split()[0] for c in columns.split(", ")]
    left = pieces.where("position IS NOT NULL")
    # One row per task.
    sums = left.groupBy("task").agg(F.sum("length").alias("n"))
    before = sums.withColumn("base", F.sum("n").over(Window.orderBy("task")) - F.col("n")).drop("n")
    total = left.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    tail, cuts = total - total % size, []
    for bit in reversed(range(size.bit_length())):
        if (total - tail) >> bit & 1:
            cuts.append((cuts[-1] if cuts else tail) + (1 << bit))
    starts = F.lit([tail, *cuts])  # of the last sequences, all shorter than `size`

    laid = left.join(before, "task").withColumn("at", F.col("base") + F.col("position"))
    begin, end = F.col("at"), F.col("at") + F.col("length")
    last = F.floor((end - 1) / size)
    borders = F.concat(
        F.array(begin, end, F.least(F.greatest(last * size, begin), end)),
        F.filter(starts, lambda s: (s > begin) & (s < end)),
    )
    parts = (
        laid.withColumn("borders", F.array_sort(F.array_distinct(borders)))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.size("borders") - 2)))
        .withColumn("from", F.get("borders", F.col("k")))
        .withColumn("n", F.get("borders", F.col("k") + 1) - F.col("from"))
        .withColumn("skip", F.col("from") - F.col("at"))
    )
    short = F.size(F.filter(starts, lambda s: s <= F.col("from")))  # 0: a full sequence
    opened = F.when(short == 0, F.floor(F.col("from") / size) * size).otherwise(F.get(starts, F.greatest(short - 1, F.lit(0))))
    number = F.when(short == 0, F.floor(F.col("from") / size)).otherwise(F.lit(tail // size) + short - 1)
    merged = parts.select(
        "doc_id", (F.col("start") + F.col("skip")).alias("start"), F.col("n").alias("length"),
        F.substring("ids", (4 * F.col("skip") + 1).cast("int"), (4 * F.col("n")).cast("int")).alias("ids"),
        "doc_tokens", (F.lit(1 << 62) + number).alias("sequence_id"), (F.col("from") - opened).alias("offset"),
    )
    return pieces.where("position IS NULL").select(names).union(merged.select(names))


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
