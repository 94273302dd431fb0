"""Token counts: texts are encoded in batches inside Arrow functions and only lengths return.

Each task regroups its rows into batches of about ``batch_bytes`` of text, so that a run of long texts
and a run of short ones cost the same memory. A text is split at safe boundaries: a single space with a
character other than white space on both sides. The byte-level vocabularies never join across it
(every pre-token that starts there takes the space along), so lengths of the units add up to the
length of the whole. Equal units are encoded once a batch and remembered up to ``cache_units``.
Vocabularies for which the boundary is not known to be safe, also those with added tokens that hold a space or take one along,
encode whole texts. A task holds one Arrow batch (bounded by the session's arrow.maxRecordsPerBatch and its byte limit).

No shuffle: one narrow pass. Defined results: null text is the empty text, with 0 tokens; repeated rows
are counted each; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

SAFE = re.compile(r"(?<=\S) (?=\S)")
LONG_UNIT = 200


def load_encoder(name: str):
    """name: a path, or the name of a file of the installed public tokenizers -> (encode batch to lengths, safe)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = name
    if not os.path.exists(path):
        import public_tokenizers

        path = public_tokenizers.path(name)
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        added = t.get_added_tokens_decoder().values()
        plain = not any(" " in a.content or a.lstrip or a.rstrip for a in added)  # such tokens reach across a space
        safe = plain and "ByteLevel" in str(t.pre_tokenizer) and "add_prefix_space=False" in str(t.pre_tokenizer) and t.normalizer is None
        t.no_truncation()
        t.no_padding()
        return (lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]), safe
    if path.endswith(".model"):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]), False
    raise ValueError(f"no encoder for {name}")


def unit_counter(encode, safe: bool, cache_units: int):
    """A function from texts to their lengths."""
    if not safe:
        return lambda texts: encode(texts) if texts else []
    first: dict[str, int] = {}
    later: dict[str, int] = {}

    def learn(known: dict[str, int], units: set[str], lead: str) -> dict[str, int]:
        """Lengths of all units; short ones are remembered."""
        if len(known) > cache_units:
            known.clear()
        new = list(units - known.keys())
        if not new:
            return known
        lengths = dict(zip(new, encode([lead + u for u in new]), strict=True))
        short = {u: n for u, n in lengths.items() if len(u) <= LONG_UNIT}
        if len(short) == len(lengths):
            known.update(lengths)
            return known
        known.update(short)
        return known | lengths

    def count(texts: list[str]) -> list[int]:
        split = [SAFE.split(t) for t in texts]
        heads = learn(first, {u[0] for u in split}, "")
        rest: set[str] = set()
        for u in split:
            rest.update(u[1:])
        tails = learn(later, rest, " ")
        get = tails.__getitem__
        return [heads[u[0]] + sum(map(get, u[1:])) for u in split]

    return count


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, batch_bytes: int = 1 << 20, cache_units: int = 300_000) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    kind = docs.schema["doc_id"].dataType
    id_type = kind.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, safe = load_encoder(tokenizer)
        count = unit_counter(encode, safe, cache_units)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pa.compute.binary_length(texts.cast(pa.binary())).to_pylist()
            start, total = 0, 0
            for i, size in enumerate(sizes):
                total += size
                if total >= batch_bytes or i == len(sizes) - 1:
                    n = i + 1 - start
                    lengths = count(texts.slice(start, n).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(start, n), pa.array(sizes[start : i + 1], pa.int64()), pa.array(lengths, pa.int64())],
                        names=["doc_id", "n_bytes", "n_tokens"],
                    )
                    start, total = i + 1, 0

    rows = docs.select("doc_id", text_of().alias("text"))
    counted = rows.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
