"""The conforming chain: trim, rename, deduplicate, dataset hook."""

from __future__ import annotations

from collections.abc import Callable, MutableMapping, Sequence

from pyspark.sql import DataFrame

from millrace.contracts import Dataset
from millrace.functions.columns import standard_name
from millrace.errors import PipelineError, TransformError
from millrace.operators.cleaning import standardize_names, trim_strings
from millrace.operators.dedup import dedup_by_key

Hook = Callable[[DataFrame, Dataset], DataFrame]

# Dataset name -> extra step on the deduplicated frame; no entry, no step.
HOOKS: dict[str, Hook] = {}


def hook(name: str, registry: MutableMapping[str, Hook] = HOOKS) -> Callable[[Hook], Hook]:
    """Decorator that makes a function the extra step of dataset `name`."""

    def register(function: Hook) -> Hook:
        registry[name] = function
        return function

    return register


def transform(
    df: DataFrame,
    contract: Dataset,
    newest_by: Sequence[str] = (),
    hooks: MutableMapping[str, Hook] = HOOKS,
) -> DataFrame:
    """Conform `df` lazily; any failure is a `PipelineError`.

    `newest_by` decides which duplicate stays. Columns in it that the contract
    does not declare are gone afterwards.
    """
    try:
        df = df.transform(trim_strings).transform(standardize_names)
        named = contract.conformed()
        newest = list(dict.fromkeys(standard_name(c) for c in newest_by))
        if contract.drop_duplicates and contract.primary_key:
            df = dedup_by_key(df, named.primary_key, newest)
        df = df.drop(*[c for c in newest if c not in named.schema.fieldNames()])
        step = hooks.get(contract.name)
        return step(df, contract) if step else df
    except PipelineError:
        raise
    except Exception as exc:
        raise TransformError(f"{contract.name}: {exc}") from exc
