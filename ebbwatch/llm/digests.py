"""SHA-256 of texts that many rows make up together."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from ebbwatch.llm.common import Batches, map_batches

EMPTY = hashlib.sha256(b"").hexdigest()


def joined_digests(rows: DataFrame, keys: list[str], order: list[str], text: str, joint: str) -> DataFrame:
    """Rows (keys, sha256): the digest of the texts of each key, in order, with ``joint`` between them.

    A digest is sequential, so the rows of a key stream through one task, which holds the state of the digest only.
    Nulls in the keys are keys as well; a text must not be null. No rows give no rows.
    """

    def work(batches: Batches) -> Batches:
        now, digest, glue = None, None, joint.encode()
        for b in batches:
            done: list[tuple] = []
            values = zip(*(b.column(k).to_pylist() for k in keys))
            for key, part in zip(values, b.column(text).to_pylist()):
                if digest is not None and key == now:
                    digest.update(glue)
                    digest.update(part.encode())
                    continue
                if digest is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(part.encode())
            yield made(done)
        if digest is not None:
            yield made([(*now, digest.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)], [*keys, "sha256"])

    kinds = [pa.string() if rows.schema[k].dataType.simpleString() == "string" else pa.int64() for k in keys] + [pa.string()]
    schema = "".join(f"`{k}` {rows.schema[k].dataType.simpleString()}, " for k in keys) + "sha256 string"
    return map_batches(rows.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, text), work, schema)
