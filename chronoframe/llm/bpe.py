"""Operator 6: byte-level BPE by the tiktoken library with a local rank file.

Long texts are cut where no match of the splitting pattern can reach across: before a space or line feed that follows
something other than white space, and between a letter and a mark (no apostrophe) for scripts without spaces. Each side
then encodes as it would in the whole text, so memory is bounded by the piece, or by the longest single match.
Decoding joins the raw bytes of the ids, whether or not a token ends inside a character.

Defined results: a null text is empty: no ids, the digests of nothing. Repeated rows stay repeated; extra columns are
dropped.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: A piece is cut at the first safe boundary after so many characters.
PIECE_CHARS = 1 << 16
_SAFE = regex.compile(r"(?<=\S)(?=[ \n])|(?<=\p{L})(?=[^\s\p{L}\p{M}\p{N}'’])")


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str):
    """(encoding, decimal text of each id with a comma, bytes of each id), once per worker process."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    size = max(ranks.values()) + 1
    raw: list[bytes] = [b""] * size
    for token, i in ranks.items():
        raw[i] = token
    return encoding, [b"%d," % i for i in range(size)], raw


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at safe boundaries into pieces of about ``most`` characters."""
    at = 0
    while len(text) - at > most:
        found = _SAFE.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    if at < len(text):
        yield text[at:]


def encode(text: str, ranks_path: str, pattern: str) -> list[int]:
    encoding = codec(ranks_path, pattern)[0]
    out: list[int] = []
    for piece in pieces(text):
        out += encoding.encode_ordinary(piece)
    return out


def decode(ids, ranks_path: str, pattern: str) -> bytes:
    return b"".join(map(codec(ranks_path, pattern)[2].__getitem__, ids))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: n_tokens, ids_sha256, decoded_sha256; with ``with_ids`` also the ids as an array."""
    kind = dict(docs.dtypes)[key]
    fields = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            counts, id_sums, text_sums, all_ids = [], [], [], []
            for i in range(batch.num_rows):
                encoding, decimal, raw = codec(ranks_path, pattern)
                n, sep, a, b, kept = 0, b"", hashlib.sha256(), hashlib.sha256(), []
                for piece in pieces(column[i].as_py() or ""):
                    ids = encoding.encode_ordinary(piece)
                    if not ids:
                        continue
                    n += len(ids)
                    a.update(sep + b"".join(map(decimal.__getitem__, ids))[:-1])
                    b.update(b"".join(map(raw.__getitem__, ids)))
                    sep = b","
                    if with_ids:
                        kept += ids
                counts.append(n)
                id_sums.append(a.hexdigest())
                text_sums.append(b.hexdigest())
                all_ids.append(kept)
            out = [batch.column(0), pa.array(np.array(counts, np.int64)), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else []), names=fields)

    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(key, text).mapInArrow(run, schema)
