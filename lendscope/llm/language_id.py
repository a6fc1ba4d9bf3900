"""Language ID (operator 7): classification by compression.

For each language a raw-content zstandard dictionary is made of training texts;
a text goes to the language whose dictionary compresses it to the fewest bytes.
The training sample is bounded: per language the ``sample_docs`` training rows
with the smallest hash of their id, each with an equal share of ``dict_bytes``
(a stretch of its text at a place given by its id's hash; with fewer rows the
shares are larger), so a dictionary draws on all of them and has the same size at
any input size. The whole lowered text is
compressed, without ASCII digits and punctuation, whatever its length.

A prediction is rejected (``rejected``) when the runner-up needs less than
``margin`` more bytes, relative to the best. ``lang_pred`` still names the best
language. ``score`` is the best language's share of 2^(-saved bits / text
length * SHARPNESS), between 1/languages and 1.

Cases: a text that is null or has no letter is ``und`` with score 0; equal sizes go to
the language with most training rows; without training rows every text is ``und``; an empty table
gives no rows; repeated rows are predicted each, other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from lendscope.llm.common import batch, fold

SAMPLE_DOCS = 200
DICT_BYTES = 96 << 10
LEVEL = 6
MARGIN = 0.01
SHARPNESS = 60.0
UND = "und"
#: ASCII digits and punctuation are left out before compressing, line ends become spaces.
_NO_LETTERS = bytes([*range(33, 65), *range(91, 97), *range(123, 128)])
_SPACES = bytes(32 if b < 32 else b for b in range(256))
_LETTER = regex.compile(r"\p{L}")  # the letter categories: no digits, fractions or numbers in circles
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                  ("score", pa.float64()), ("margin", pa.float64()), ("rejected", pa.bool_())])


def _letters(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_SPACES, _NO_LETTERS)


def learn_dictionaries(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw dictionary content by language, from a bounded sample of ``train``.

    The sample is chosen on ids alone (Spark limits each language map-side), then
    its texts are fetched: at most ``sample_docs`` rows a language, cut to their
    shares before they reach the driver. An id with several texts gives a row for
    each."""
    usable = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0))
    common = {r[lang_col]: r["count"] for r in usable.groupBy(lang_col).count().collect()}  # a row a language
    rank = F.row_number().over(Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col))
    ids = (usable.select(lang_col, id_col).withColumn("_rank", rank).where(F.col("_rank") <= sample_docs)
           .withColumn("_share", F.ceil(F.lit(dict_bytes) / F.count(F.lit(1)).over(Window.partitionBy(lang_col))))
           .select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), "_rank", "_share"))
    share = F.col("_share").cast("int")
    at = F.pmod(F.xxhash64("_id"), F.greatest(F.length(text_col) - share + 1, F.lit(1))).cast("int") + 1
    rows = (usable.join(F.broadcast(ids), (usable[id_col] == F.col("_id")) & (usable[lang_col] == F.col("_lang")))
            .select("_lang", "_rank", F.substring(F.col(text_col), at, share).alias("_text"))  # sample_docs rows a language
            .orderBy("_lang", F.desc("_rank"), "_text").collect())
    parts: dict[str, list[bytes]] = {}
    for lang, _, text in rows:
        parts.setdefault(lang, []).append(_letters(text))
    return {lang: b"\n".join(parts[lang])[-dict_bytes:] for lang in sorted(parts, key=lambda x: (-common[x], x))}


def _predict(dictionaries: dict[str, bytes], margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = {}
        for lang, raw in dictionaries.items():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            packers[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                     write_dict_id=False)
        for b in batches:
            rows = []
            for doc, held, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not packers or text is None or not _LETTER.search(text):
                    rows.append((doc, held, UND, 0.0, 0.0, True))
                    continue
                raw = _letters(text)
                sizes = {lang: len(p.compress(raw)) for lang, p in packers.items()}
                best = min(sizes, key=sizes.get)
                second = min((s for lang, s in sizes.items() if lang != best), default=sizes[best])
                gap = (second - sizes[best]) / max(1, sizes[best])
                rel = SHARPNESS / max(1, len(raw))
                score = 1.0 / sum(math.exp(-min(700.0, (s - sizes[best]) * rel)) for s in sizes.values())
                rows.append((doc, held, best, score, gap, len(sizes) > 1 and gap < margin))
            if rows:
                yield batch(_OUT, *zip(*rows))
    return run


def predict_language(docs: DataFrame, train: DataFrame, held_out=None, id_col: str = "doc_id",
                     text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN,
                     sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin, rejected for every row of ``docs``."""
    held_out = F.lit(False) if held_out is None else held_out
    dictionaries = learn_dictionaries(train, id_col, text_col, lang_col, sample_docs, dict_bytes)
    return (docs.select(F.col(id_col).cast("long"), held_out.cast("boolean"), F.col(text_col).cast("string"))
            .mapInArrow(_predict(dictionaries, margin),
                        "doc_id long, held_out boolean, lang_pred string, score double, margin double, "
                        "rejected boolean"))


def held_out_language(docs: DataFrame) -> DataFrame:
    """The registered query: learn from crc32(doc_id) mod 3 != 1, predict all."""
    held = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return predict_language(docs, docs.where(~held), held)
