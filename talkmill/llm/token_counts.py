"""Token counts of whole texts with a public tokenizer.

Texts go to an Arrow function that returns lengths only.  A batch is a number
of bytes, not of rows: rows are joined up to ``BATCH`` bytes and a longer text
is split.  Every split is at a blank, which no token spans in a tokenizer that
drops white space; a stretch without blanks stays whole.  Equal stretches of a
batch are encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import arrow_bytes, by_bytes, ship_package, text_of

BATCH = 8_000_000
REMEMBER = 400_000  # counts of short stretches that a worker keeps
SHORT = 64

_TOKENIZERS: dict[str, object] = {}
_COUNTS: dict[str, dict[str, int]] = {}


def _tokenizer(definition: str):
    """The tokenizer of a definition (JSON text), made once per worker."""
    from tokenizers import Tokenizer

    if definition not in _TOKENIZERS:
        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _TOKENIZERS[definition] = tokenizer
    return _TOKENIZERS[definition]


def split_at_blanks(data: np.ndarray, at: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in batches of at most ``most`` bytes: the bytes, where pieces
    begin, and the number of the text that each piece belongs to."""
    for low, high in by_bytes(np.diff(at), most):
        part, bounds = data[at[low] : at[high]], at[low : high + 1] - at[low]
        if high - low > 1 or len(part) <= most:
            yield part, bounds, np.arange(low, high)
            continue
        begin = 0
        while begin < len(part):
            end = min(begin + most, len(part))
            if end < len(part):
                blanks = np.flatnonzero(part[begin:end] == 32)
                if len(blanks):
                    end = begin + int(blanks[-1]) + 1
                else:
                    later = np.flatnonzero(part[end:] == 32)
                    end = end + int(later[0]) + 1 if len(later) else len(part)
            yield part[begin:end], np.array([0, end - begin]), np.array([low])
            begin = end


def _counts(definition: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition)
        known = _COUNTS.setdefault(definition, {})
        for batch in batches:
            data, at = arrow_bytes(batch.column("text"))
            totals = np.zeros(batch.num_rows, np.int64)
            for part, bounds, owner in split_at_blanks(data, at, BATCH):
                begins = (part == 32)
                begins[bounds[:-1][bounds[:-1] < len(part)]] = True
                starts = np.flatnonzero(begins)
                if not len(starts):
                    continue
                pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(part)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(part)))
                coded = pieces.dictionary_encode()
                texts = coded.dictionary.to_pylist()
                sizes = [known.get(t, -1) for t in texts]
                new = [i for i, n in enumerate(sizes) if n < 0]
                for i, encoded in zip(new, tokenizer.encode_batch_fast([texts[i] for i in new], add_special_tokens=False)):
                    sizes[i] = len(encoded)
                    if len(texts[i]) <= SHORT and len(known) < REMEMBER:
                        known[texts[i]] = sizes[i]
                each = np.array(sizes, np.int64)[coded.indices.to_numpy()]
                upto = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, bounds)]
                totals[owner] += np.diff(upto)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(totals)], names=[*kept, "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, *, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row.

    ``tokenizer_path`` names a JSON definition whose tokens never span a
    blank; the driver reads it and sends it along.  No begin, end or added
    special token counts, special strings inside texts are what the library
    takes them for by default, nothing is cut or padded.  Null counts as empty
    (0 tokens); null ids and repeated rows are rows like others; an empty
    table gives an empty one.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"), text_of(text).alias("text")
    )
    counted = rows.mapInArrow(_counts(definition), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
