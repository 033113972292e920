"""User extensions: transforms applied to the parsed records, in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Extension = Callable[[DataFrame], DataFrame]

_REGISTRY: dict[str, Extension] = {}


def register_extension(name: str) -> Callable[[Extension], Extension]:
    """Make a transform available by name."""

    def add(extension: Extension) -> Extension:
        _REGISTRY[name] = extension
        return extension

    return add


def load_extension(name: str) -> Extension:
    try:
        return _REGISTRY[name]
    except KeyError:
        known = ", ".join(sorted(_REGISTRY)) or "none"
        raise ValueError(f"extension {name!r} is not registered (known: {known})") from None


def apply_extensions(
    records: DataFrame, extensions: Iterable[str | Extension] = ()
) -> DataFrame:
    """Apply extensions last in the record pipeline; one may also drop rows."""
    for extension in extensions:
        if isinstance(extension, str):
            extension = load_extension(extension)
        records = records.transform(extension)
    return records


def pandas_extension(
    function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> Extension:
    """An extension from a function over batches of rows, for logic that no
    column expression can state. ``schema`` is that of the result."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return lambda records: records.mapInPandas(run, schema)
