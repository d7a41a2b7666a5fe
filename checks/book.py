"""A book of named SQL tables; `compose` puts the ones a query needs in front of it as CTEs."""

from __future__ import annotations

import re

from keepwell.sources.retail import DUCKDB_DIALECT, EVENTS, LINES, RAW_SQL, render

BOOK: dict[str, str] = {
    "lines": render(LINES, DUCKDB_DIALECT),
    "clicks": render(EVENTS, DUCKDB_DIALECT),
    **{f"raw_{name}": render(sql, DUCKDB_DIALECT) for name, sql in RAW_SQL.items()},
}


def add(name: str, sql: str) -> None:
    assert name not in BOOK, name
    BOOK[name] = sql.strip()


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b(?:from|join)\s+([a-z_0-9]+)", sql, flags=re.I))
    return sorted(w for w in words if w in BOOK)


def compose(sql: str) -> str:
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text):
            if name not in ordered:
                visit(BOOK[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    parts = ",\n".join(f"{name} AS MATERIALIZED (\n{BOOK[name]}\n)" for name in ordered)
    return f"WITH {parts}\n{sql.strip()}"


# ------------------------------------------------------------------ expression helpers
def day(c: str) -> str:
    return f"cast(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d-%m-%Y')) as date)"


def stamp(c: str) -> str:
    return (f"coalesce(try_strptime({c}, '%Y-%m-%dT%H:%M:%S'), try_strptime({c}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({c}, '%d-%m-%Y %H:%M'), try_cast({c} as timestamp))")


def iso_day(c: str) -> str:
    return f"cast(try_cast({c} as timestamp) as date)"


def num(c: str) -> str:
    return f"try_cast({c} as double)"


def whole(c: str) -> str:
    return f"try_cast({c} as integer)"


def flag(c: str) -> str:
    return f"try_cast({c} as boolean)"


def units(c: str) -> str:
    """A money or small decimal value as an integer number of 1/10000."""
    return f"cast(round(cast(({c}) as double) * 10000) as hugeint)"


def half_up(top: str, bottom: str, digits: int) -> str:
    """top / bottom rounded half away from zero, on integers only; null when bottom is zero."""
    t, b = f"cast(({top}) as hugeint) * {10 ** digits}", f"cast(({bottom}) as hugeint)"
    mag = f"((2 * abs({t}) + {b}) // nullif(2 * {b}, 0))"
    return f"(cast(sign({top}) * {mag} as double) / {10 ** digits})"


def money_total(c: str, digits: int = 2) -> str:
    return half_up(f"sum({units(c)})", "10000", digits)


def money_mean(c: str, digits: int = 2) -> str:
    return half_up(f"sum({units(c)})", f"10000 * count({c})", digits)


def keep_one(select_sql: str, key: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in columns if c != key)
    return (f"select {', '.join([key] + [c for c in columns if c != key])} from (select *, row_number() over "
            f"(partition by {key} order by {order}) as rn from ({select_sql})) where rn = 1")
