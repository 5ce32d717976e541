"""Comparison of result frames."""

from __future__ import annotations


def same_rows(got, want) -> None:
    """Two pandas frames with equal columns and, whatever the order, equal rows."""
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert len(got) == len(want)
    got, want = (x[columns].sort_values(columns, ignore_index=True) for x in (got, want))
    for c in columns:
        differ = (got[c] != want[c]) & ~(got[c].isna() & want[c].isna())
        assert not differ.any(), f"{c}: {got[c][differ].head(3).tolist()} and {want[c][differ].head(3).tolist()}"
