"""The library's jobs over the given star-schema tables, each with its plain SQL."""

from analogues import loads, nesting, series, stored

CASES = [*loads.CASES, *series.CASES, *nesting.CASES, *stored.CASES]
