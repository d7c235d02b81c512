"""The declared keys of the staging and target tables, checked over a run's own tables in one pass.

Every row is turned into claims (constraint, key, side): it holds a key that has to be unique, refers to a key of another
table, or is the row others refer to. The claims of all tables are stacked and meet in a single aggregation on (constraint, key),
so a table is read once however many constraints name it, and a key that many rows refer to is one row per task before
the shuffle.

Fixed values: the declarations below are those of the target schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIMARY_KEYS = {
    "stg_clients": ["id"], "stg_unmanaged_clients": ["id"], "stg_posts": ["id"], "stg_insights": ["id"],
    "ods_clients": ["client_id"], "ods_posts": ["post_id"], "ods_insights": ["insight_id"],
    "ods_data_video": ["post_id"],
    "ods_fans_country": ["insight_id", "country"], "ods_fans_city": ["insight_id", "city"],
    "ods_fans_locale": ["insight_id", "locale"],
    "dim_date": ["date_id"], "dim_client": ["client_id"], "dim_post_type": ["post_type_id"],
    "dim_location": ["location_id"], "fact_posts": ["post_id"], "fact_insights": ["insight_id"],
    "fact_fan_demographics": ["fact_id"],
}
UNIQUE_KEYS = {"dim_date": ["full_date"], "dim_post_type": ["label"], "dim_location": ["location_type", "location_label"]}
FOREIGN_KEYS = [  # child, column, parent, column
    ("ods_posts", "client_id", "ods_clients", "client_id"), ("ods_insights", "client_id", "ods_clients", "client_id"),
    ("ods_data_video", "post_id", "ods_posts", "post_id"),
    ("ods_fans_country", "insight_id", "ods_insights", "insight_id"), ("ods_fans_country", "client_id", "ods_clients", "client_id"),
    ("ods_fans_city", "insight_id", "ods_insights", "insight_id"), ("ods_fans_city", "client_id", "ods_clients", "client_id"),
    ("ods_fans_locale", "insight_id", "ods_insights", "insight_id"), ("ods_fans_locale", "client_id", "ods_clients", "client_id"),
    ("fact_posts", "client_id", "dim_client", "client_id"), ("fact_posts", "date_id", "dim_date", "date_id"),
    ("fact_posts", "post_type_id", "dim_post_type", "post_type_id"),
    ("fact_insights", "client_id", "dim_client", "client_id"), ("fact_insights", "date_id", "dim_date", "date_id"),
    ("fact_fan_demographics", "client_id", "dim_client", "client_id"), ("fact_fan_demographics", "date_id", "dim_date", "date_id"),
    ("fact_fan_demographics", "location_id", "dim_location", "location_id"),
]


PRIMARY, UNIQUE, FOREIGN = "primary key", "unique", "foreign key"
INTEGERS = ("tinyint", "smallint", "int", "bigint")


@dataclass
class Constraint:
    """A declared key; ``parent`` and ``parent_columns`` for a foreign key."""
    kind: str
    table: str
    columns: Sequence[str]
    parent: str | None = None
    parent_columns: Sequence[str] = ()
    numeric: bool = False

    @property
    def name(self) -> str:
        of = f"foreign key to {self.parent} of" if self.kind == FOREIGN else self.kind
        return f"{of} {self.table}({', '.join(self.columns)})"

    def holders(self) -> list[tuple[str, Sequence[str], bool]]:
        """The sides of the constraint: (table, its columns, whether it is the side that is checked)."""
        own = [(self.table, self.columns, True)]
        return own + ([(self.parent, self.parent_columns, False)] if self.parent else [])


def declared() -> list[Constraint]:
    return ([Constraint(PRIMARY, t, k) for t, k in PRIMARY_KEYS.items()] + [Constraint(UNIQUE, t, k) for t, k in UNIQUE_KEYS.items()]
            + [Constraint(FOREIGN, child, [c], parent, [p]) for child, c, parent, p in FOREIGN_KEYS])


def _checkable(tables: dict[str, DataFrame], kinds: Sequence[str]) -> list[Constraint]:
    """The declared constraints of these kinds whose tables and columns are there. A key that starts with an integer on every
    side is numeric: that column travels as a long, all others as text."""
    types = {t: dict(df.dtypes) for t, df in tables.items()}
    checks = [c for c in declared() if c.kind in kinds and all(set(cols) <= set(types.get(t, ())) for t, cols, _ in c.holders())]
    for c in checks:
        c.numeric = all(types[t][cols[0]] in INTEGERS for t, cols, _ in c.holders())
    return checks


def _claim_sql(number: int, c: Constraint, cols: Sequence[str], checked: bool, numeric: bool) -> str:
    # as text: a Column built node by node costs a driver round trip per node
    texts = ", ".join(f"CAST(`{x}` AS STRING)" for x in (cols[1:] if numeric else cols))
    num = f"CAST(`{cols[0]}` AS BIGINT)" if numeric else "CAST(NULL AS BIGINT)"
    txt = f"array({texts})" if texts else "CAST(NULL AS ARRAY<STRING>)"
    claim = f"named_struct('c', {number}, 'num', {num}, 'txt', {txt}, 'checked', {str(checked).lower()})"
    if c.kind == PRIMARY:
        return claim                        # a null in a primary key is a violation; elsewhere it makes no claim
    return f"CASE WHEN {' AND '.join(f'`{x}` IS NOT NULL' for x in cols)} THEN {claim} END"


def claims(tables: dict[str, DataFrame], checks: Sequence[Constraint]) -> DataFrame | None:
    """Rows (c, num, txt, checked) of all ``tables`` for the constraints, one pass per table."""
    by_table: dict[str, list[str]] = {}
    for i, c in enumerate(checks):
        for table, cols, checked in c.holders():
            by_table.setdefault(table, []).append(_claim_sql(i, c, cols, checked, c.numeric))
    parts = [tables[t].selectExpr(f"inline(array({', '.join(own)}))").where("c IS NOT NULL") for t, own in by_table.items()]
    return reduce(DataFrame.unionByName, parts) if parts else None


def violations(tables: dict[str, DataFrame], kinds: Sequence[str] = (PRIMARY, UNIQUE, FOREIGN)) -> DataFrame | None:
    """(broken, value, n_rows): every key value that breaks a declared constraint and how many rows hold it, over the
    tables given; constraints on other tables or on columns a table does not have are skipped. None without any."""
    checks = _checkable(tables, kinds)
    stacked = claims(tables, checks)
    if stacked is None:
        return None
    met = stacked.groupBy("c", "num", "txt").agg(F.count_if("checked").alias("n_rows"), F.bool_or(~F.col("checked")).alias("known"))
    # literal lists by constraint number, as text again
    kind, name, numeric = (f"element_at(array({', '.join(vs)}), c + 1)" for vs in (
        [f"'{c.kind}'" for c in checks], [f"'{c.name}'" for c in checks], [str(c.numeric).lower() for c in checks]))
    empty = "CAST(array() AS ARRAY<STRING>)"
    keyed = met.selectExpr(f"{kind} AS kind", f"{name} AS broken", "n_rows", "known",
                           f"concat(CASE WHEN {numeric} THEN array(CAST(num AS STRING)) ELSE {empty} END, coalesce(txt, {empty})) AS key")
    broken = f"""CASE kind WHEN '{FOREIGN}' THEN NOT known AND n_rows > 0 WHEN '{UNIQUE}' THEN n_rows > 1
                 ELSE n_rows > 1 OR exists(key, k -> k IS NULL) END"""
    return keyed.where(broken).selectExpr("broken", "array_join(key, '|', 'NULL') AS value", "CAST(n_rows AS BIGINT) AS n_rows")
