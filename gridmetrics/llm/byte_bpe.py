"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are split before encoding at safe boundaries: between a printable ASCII character and
white space no match of the pattern can continue, so the pieces encode as the whole does. Very long
runs of white space, which the pattern would backtrack over, are cut the way the pattern cuts them.
Decoding goes to raw bytes.

The driver reads the rank file (its path is a parameter) and broadcasts it: a vocabulary file does
not grow with the data. Defined results: null is empty text with no ids; repeated rows give repeated
rows; columns besides id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, ship, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters after which a long text is split at the next safe boundary.
PIECE = 1 << 15
_SAFE = re.compile(r"(?<=[!-~])(?=[ \n])")
#: A run of blanks and line feeds longer than this is encoded as the pattern's own matches.
_RUN = re.compile(r"[ \n]{4096,}")


@lru_cache(maxsize=2)
def encoding(ranks: bytes, pattern: str):
    """The tiktoken encoding of a rank file's content, without special tokens."""
    import tiktoken

    merges = {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in ranks.splitlines() if line)
    }
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut only at safe boundaries."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(codec, text: str) -> list[int]:
    """Ids of the text, as ``encode_ordinary`` gives them for the whole."""
    ids: list[int] = []
    for piece in pieces(text):
        at = 0
        for run in _RUN.finditer(piece):
            # Only a run with a match's start at its own start can be encoded on its own.
            if run.start() and piece[run.start() - 1].isspace():
                continue
            last = run.end() < len(piece)
            if last and piece[run.end()].isspace():
                continue
            ids.extend(codec.encode_ordinary(piece[at : run.start()]))
            end = run.end() - 1 if last else run.end()
            ids.extend(codec._encode_single_piece(piece[run.start() : end]))
            at = end
        ids.extend(codec.encode_ordinary(piece[at:]))
    return ids


def encode_documents(
    documents: DataFrame,
    ranks: bytes,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    output: str = "all",
) -> DataFrame:
    """Encode and decode every text.

    ``output='all'`` returns doc_id, ids, the decoded bytes and the digests of both; ``'digest'``
    only counts and digests, which keeps a check of a whole corpus small.
    """
    shared = documents.sparkSession.sparkContext.broadcast((ranks, pattern))

    def of(rows):
        codec = encoding(*shared.value)
        names = [str(i) for i in range(codec.n_vocab)]
        for row in rows:
            ids = encode(codec, row["text"])
            decoded = codec.decode_bytes(ids)
            joined = ",".join([names[i] for i in ids]).encode()
            digests = hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest()
            whole = (ids, decoded) if output == "all" else ()
            yield (row["doc_id"], len(ids), *digests, *whole)

    kind = documents.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if output == "all":
        schema += ", ids array<int>, decoded binary"
    named = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return map_rows(named, schema, of, "text")


def decode_documents(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and raw bytes of each row's ``ids``; a null list decodes to nothing."""
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast((ranks, pattern))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        codec = encoding(*shared.value)
        for batch in batches:
            decoded = [codec.decode_bytes(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(decoded, pa.binary())], ["doc_id", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded binary")


def rank_file(name: str = RANKS) -> tuple[bytes, str]:
    """Content of an installed rank file, and the pattern that goes with it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: digests of ids and decoded bytes of every text of ``documents``."""
    return encode_documents(table(spark, sf_dir, "documents"), *rank_file(), output="digest")
