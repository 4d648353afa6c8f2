"""Language identification by compression: the language whose zstandard dictionary shortens a text most.

Every text is cut into blocks, so that a long text doesn't become its own dictionary, and each
block of it is encoded with a raw-content dictionary of each language. The language of the smallest
sum wins; a narrow margin rejects the text. One encoder measures all texts.

Cases: a null or empty text, or one without letters that any dictionary knows, is rejected with a
null language; equal sums are a margin of 0, so rejected (were NARROW 0, the first language by name
would win); repeated rows get equal results; a null doc_id is classified like others; texts of any
length are encoded whole; with an empty table, or no labelled row, everything is rejected; with one
labelled language all texts are its own. Other columns pass through whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.llm.words import buffers, parts

#: The bound of the labelled sample: documents a language, and bytes of its dictionary.
SAMPLE_DOCS, DICT_BYTES = 96, 65_536
BLOCK = 4096
#: Bytes gained per byte of text under which a text is rejected.
NARROW = 0.004
#: Level and least match of the encoder.
ENCODER = (6, 4)
SEED = 17
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("margin", T.DoubleType())])

_built: dict = {}


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Dictionaries from a bounded, seeded sample of the rows labelled in lang. Label counts cover all rows."""
    rows = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    count = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not count:
        return {}
    h = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    most = F.lit(0)
    for lang, n in count.items():
        most = F.when(F.col("lang") == lang, int((1 << 30) * min(1.0, 2.0 * sample_docs / n))).otherwise(most)
    # Twice the bound is expected, so that the bound itself is met; ties of h fall by id, then text.
    # A document gives no more than the whole dictionary: what goes to the driver is bounded.
    found = rows.select("lang", "doc_id", h.alias("h"), F.substring(F.lower("text"), 1, dict_bytes).alias("text")).where(F.col("h") <= most)
    own_rows: dict[str, list] = {}
    for r in found.collect():
        own_rows.setdefault(r["lang"], []).append((r["h"], str(r["doc_id"]), r["text"].encode()))
    out = {}
    for lang, own in own_rows.items():
        own = sorted(own)[:sample_docs]
        share = max(256, dict_bytes // len(own))
        spare = dict_bytes - sum(min(share, len(x)) for _, _, x in own)
        whole = b""
        for _, _, x in own:
            n = share + max(0, min(spare, len(x) - share))
            spare -= max(0, n - share)
            whole += x[:n] + b"\n"
        out[lang] = whole[:dict_bytes]
    return out


def _compressors(dicts: dict[str, bytes]) -> list:
    key = tuple(sorted((k, hash(v)) for k, v in dicts.items()))
    if key not in _built:
        _built.clear()
        made = []
        for lang in sorted(dicts):
            p = zstandard.ZstdCompressionParameters.from_level(ENCODER[0], source_size=BLOCK, dict_size=len(dicts[lang]), min_match=ENCODER[1], write_content_size=0, write_checksum=0, write_dict_id=0)
            d = zstandard.ZstdCompressionDict(dicts[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            made.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=p)))
        _built[key] = made
    return _built[key]


def classify(text: bytes, dicts: dict[str, bytes]) -> tuple[str | None, float]:
    """Language (None: rejected) and margin of one lower-case text."""
    made = _compressors(dicts)
    if not text.strip() or not made:
        return None, 0.0
    if len(made) == 1:
        return made[0][0], 1.0
    blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in made]
    best = min(range(len(made)), key=sizes.__getitem__)
    margin = (sorted(sizes)[1] - sizes[best]) / len(text)
    return (made[best][0] if margin >= NARROW else None), margin


def identified(dicts: dict[str, bytes]):
    """struct(lang, margin) of a lower-case text column, as a function of it."""

    @F.arrow_udf(RESULT)
    def compressed(text: pa.Array) -> pa.Array:
        got = []
        for part in parts(text):
            off, data = buffers(part)
            raw = data.tobytes()
            got += [classify(raw[a:b], dicts) for a, b in zip(off[:-1], off[1:])]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["lang", "margin"])

    return compressed(F.lower("text"))


def language_id(docs: DataFrame, dicts: dict[str, bytes] | None = None) -> DataFrame:
    """doc_id, predicted language (null: rejected), margin in bytes gained per byte, accepted."""
    dicts = train(docs) if dicts is None else dicts
    got = docs.select("doc_id", identified(dicts).alias("found"))
    return got.select("doc_id", F.col("found.lang").alias("predicted"), F.round("found.margin", 6).alias("margin"), F.col("found.lang").isNotNull().alias("accepted"))


def keep_identified(docs: DataFrame, dicts: dict[str, bytes] | None = None) -> DataFrame:
    """The rows of docs with an accepted language, their columns as they came."""
    dicts = train(docs) if dicts is None else dicts
    return docs.where(identified(dicts).getField("lang").isNotNull())
