"""Token counts: lengths only, batches balanced by bytes, long texts split at safe boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices

SPLIT_BYTES = 1 << 16
#: A blank after something that is neither a blank nor the blank's own piece character. The following
#: part is encoded with its own leading blank, which is exactly the blank that is taken away here.
_SAFE = re.compile(r"(?<=[^ ▁]) (?=.)", re.S)


@lru_cache(maxsize=4)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def splittable(path: str) -> bool:
    """Whether cutting before a blank can never change the pieces: no piece continues over a blank,
    the model adds a leading blank to what it encodes and keeps repeated blanks."""
    p = _processor(path)
    inner = any("▁" in p.id_to_piece(i).lstrip("▁") for i in range(p.get_piece_size()))
    probe = ["▁" in "".join(p.encode(x, out_type=str))[:1] for x in ("a", " a")]
    keeps = "".join(p.encode("a  b", out_type=str)) == "▁a▁▁b" and "".join(p.encode("a ", out_type=str)) == "▁a▁"
    return not inner and all(probe) and keeps


def safe_parts(text: str, most: int = SPLIT_BYTES) -> list[str]:
    """``text`` in parts of about ``most`` characters whose token counts add up to the whole's."""
    if len(text) <= most:
        return [text]
    parts, lo = [], 0
    while len(text) - lo > most:
        m = _SAFE.search(text, lo + most)
        if not m:
            break
        parts.append(text[lo:m.start()])
        lo = m.end()
    return [*parts, text[lo:]]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, batch_bytes: int = 4 << 20) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, by the sentencepiece model at ``model_path``.

    Null and empty texts have 0 bytes and 0 tokens. Rows are never merged: repeated ids and rows come
    back as often as they came. Other columns are ignored. No shuffle; a task holds one Arrow batch,
    encodes about ``batch_bytes`` of text at a time and returns lengths only.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, cut = _processor(model_path), splittable(model_path)
        for batch in batches:
            sizes, counts, texts = [], [], batch.column(1)
            for lo, hi in text_slices(texts, batch_bytes):
                parts, owner = [], []
                for k, t in enumerate(texts.slice(lo, hi - lo).to_pylist()):
                    sizes.append(len(t.encode()) if t else 0)
                    own = safe_parts(t or "") if cut else [t or ""]
                    parts += own
                    owner += [k] * len(own)
                total = [0] * (hi - lo)
                for k, ids in zip(owner, sp.encode(parts, out_type=int, num_threads=1)):
                    total[k] += len(ids)
                counts += total
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), n, pa.array([c > limit for c in counts], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(lengths, schema)
