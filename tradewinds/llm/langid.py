"""Language by compression: the language whose dictionary lets zstandard write a text shortest.

Every language gets a raw-content dictionary of up to `DICTIONARY_BYTES`, made of pieces of up
to `PIECE_CHARS` characters from `SAMPLE_DOCS` of its documents (those whose ids hash lowest):
the bounded sample that the classifier is fitted on. A whole text, lower-cased, is compressed
once with each dictionary; the smallest result wins, ties go to the language first by name.

`score` is a softmax over the sizes, halving with every byte more. `rejected` tells that the best
is less than `MARGIN` shorter than the second: the prediction is then a guess.

Defined cases: null texts and texts without a letter are `und` with score 0, rejected; where
there is nothing to learn from, so is every text; very long texts are compressed in full;
repeated rows get a row each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, held_out, map_documents, sampled

SAMPLE_DOCS = 400
PIECE_CHARS = 400
DICTIONARY_BYTES = 112_640
MARGIN = 0.01
#: Texts are compressed in pieces of so many bytes, so that a long text is measured against the
#: dictionary and not against itself.
BLOCK_BYTES = 1_500
UNKNOWN = "und"


def dictionaries(docs: DataFrame, parts: int = 4, part: int = 2) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from documents that are not held out."""
    # A piece from the middle: openings are alike in many documents.
    middle = F.greatest(F.lit(1), ((F.length("text") - PIECE_CHARS) / 2).cast("int"))
    seen = F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), parts, part)
    pieces = (
        documents(docs, "lang").where(seen).where(F.col("text").rlike(r"\p{L}"))
        .select("doc_id", "lang", F.substring("text", middle, F.lit(PIECE_CHARS)).alias("text"))
    )
    found: dict[str, list[str]] = {}
    for row in sampled(pieces, SAMPLE_DOCS, "lang", docs.where(seen)).orderBy("lang", F.xxhash64("doc_id"), "doc_id", "text").collect():
        found.setdefault(row.lang, []).append(row.text.lower())
    return {lang: "\n".join(texts).encode("utf-8", "replace")[-DICTIONARY_BYTES:] for lang, texts in found.items()}


def _predictor(learned: dict[str, bytes]):
    names = sorted(learned)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        settings = zstandard.ZstdCompressionParameters(
            window_log=18, hash_log=16, chain_log=17, search_log=4, min_match=4, target_length=32,
            strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False,
        )
        compressors = [
            zstandard.ZstdCompressor(
                compression_params=settings,
                dict_data=zstandard.ZstdCompressionDict(learned[n], dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for n in names
        ]
        for batch in batches:
            rows = []
            for text in batch["text"]:
                if not compressors or not any(map(str.isalpha, text)):
                    rows.append((UNKNOWN, 0.0, True))
                    continue
                data = text.lower().encode("utf-8", "replace")
                pieces = [data[k:k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
                sizes = [sum(len(c.compress(p)) for p in pieces) for c in compressors]
                best = min(sizes)
                second = min([s for k, s in enumerate(sizes) if k != sizes.index(best)], default=2 * best)
                score = 1 / sum(2.0 ** max(best - s, -60) for s in sizes)
                rows.append((names[sizes.index(best)], score, second - best < MARGIN * second))
            pred, score, rejected = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pred, "score": score,
                "rejected": rejected,
            })

    return predict


def predict_language(docs: DataFrame, learned: dict[str, bytes], parts: int = 4, part: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of `docs`."""
    return map_documents(
        documents(docs).withColumn("held_out", held_out(F.col("doc_id"), parts, part)),
        _predictor(learned), "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
    )
