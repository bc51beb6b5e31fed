"""Python functions of one text, applied to Arrow batches in small slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

SLICE = 256  # texts held as Python strings at a time


def per_slice(text: str, result: str, prepare: Callable[[], Callable[[list[str | None]], list]]) -> Column:
    """A column of the DDL type ``result``: what the function made by ``prepare`` gives for a list of texts.

    ``prepare`` runs once per task. Structs are returned as tuples.
    """
    arrow_type = to_arrow_type(DataType.fromDDL(result))

    @F.arrow_udf(result)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = prepare()
        for batch in batches:
            parts = [
                pa.array(function(batch.slice(at, SLICE).to_pylist()), arrow_type)
                for at in range(0, len(batch), SLICE)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], arrow_type)

    return run(F.col(text))
