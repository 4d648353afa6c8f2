"""Token counters by name, made once in a worker.

`words` counts runs of word characters and single other characters; it stands in where no vocabulary is
given, and isn't any model's tokenizer. Vocabulary files are named by their paths.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_made: dict[tuple[str, str | None], Callable[[str], int]] = {}
_WORDS = re.compile(r"\w+|[^\w\s]")
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _words(path: str | None) -> Callable[[str], int]:
    return lambda text: len(_WORDS.findall(text))


def _ranks(path: str | None) -> Callable[[str], int]:
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(known.encode_ordinary(text))


def _json(path: str | None) -> Callable[[str], int]:
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    return lambda text: len(known.encode(text, add_special_tokens=False).ids)


def _pieces(path: str | None) -> Callable[[str], int]:
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: len(known.encode(text))


COUNTERS: dict[str, Callable[[str | None], Callable[[str], int]]] = {"words": _words, "ranks": _ranks, "json": _json, "pieces": _pieces}


def token_count(text: Column, name: str = "words", path: str | None = None) -> Column:
    """Tokens of a text; null of a null."""
    if name not in COUNTERS:
        raise ValueError(f"unknown tokenizer {name}; known: {', '.join(COUNTERS)}")

    @F.arrow_udf(T.IntegerType())
    def count(texts: pa.Array) -> pa.Array:
        key = (name, path)
        if key not in _made:
            _made[key] = COUNTERS[name](path)
        return pa.array([None if t is None else _made[key](t) for t in texts.to_pylist()], pa.int32())

    return count(text)
