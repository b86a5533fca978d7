"""Masks, row filters and role views as projections and joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The roles. Roles that see unmasked columns, cost columns and audit columns.
UNMASKED = {"platform_admin"}
SEES_COST = {"platform_admin", "finance", "workspace_owner", "viewer"}
SEES_AUDIT = {"platform_admin", "security", "workspace_owner"}


def secure_view(
    df: DataFrame,
    role: str,
    masks: Mapping[str, Callable[[Column], Column]] | None = None,
    row_filter: Column | None = None,
    unmasked: Sequence[str] = tuple(UNMASKED),
) -> DataFrame:
    """Masked columns and filtered rows, except for roles that may see everything."""
    if role in unmasked:
        return df
    if row_filter is not None:
        df = df.filter(F.coalesce(row_filter, F.lit(False)))
    return df.withColumns({c: f(F.col(c)) for c, f in (masks or {}).items() if c in df.columns})


def assigned_rows(df: DataFrame, grants: DataFrame, user: str, key: str = "workspace_id") -> DataFrame:
    """Rows of the workspaces granted to a user. The grants are filtered before the join."""
    mine = grants.filter(F.col("user_name") == user).select(key).distinct()
    return df.join(mine, key, "left_semi")


def role_view(kind: str, df: DataFrame, role: str, grants: DataFrame | None = None, user: str | None = None) -> DataFrame:
    """``kind`` is ``cost`` or ``audit``; a role without access gets no rows."""
    allowed = SEES_COST if kind == "cost" else SEES_AUDIT
    if role not in allowed:
        return df.limit(0)
    if role == "workspace_owner":
        if grants is None or user is None:
            raise ValueError("an owner view needs grants and a user")
        return assigned_rows(df, grants, user)
    if role == "viewer":
        hidden = [c for c in ("user_id", "service_principal_id", "custom_tags") if c in df.columns]
        return df.drop(*hidden)
    return df
