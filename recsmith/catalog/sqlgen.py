"""Small SQL builders for the DuckDB twins (test-side only)."""

from __future__ import annotations


def first_sql(src: str, keys: list[str], order: list[str], cols: list[str], desc: bool = False) -> str:
    """First row per key by ``order`` (all ascending, or all descending)."""
    d = " DESC" if desc else ""
    o = ", ".join(c + d for c in order)
    k = ", ".join(keys)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) "
            f"AS _rn FROM ({src}) _s) _t WHERE _rn = 1")


def positional_merge_sql(left: str, right: str, key: str, lorder: list[str], rorder: list[str],
                         lcols: list[str], rcols: list[str], slot: bool = False) -> str:
    """Sequential match-merge (keep groups with left rows): slot i pairs left
    row min(i, nl) with right row min(i, nr)."""
    lo, ro = ", ".join(lorder), ", ".join(rorder)
    sel = ", ".join(["s.slot AS slot"] * slot + [f"s.{key} AS {key}"] + [f"l.{c} AS {c}" for c in lcols] + [f"r.{c} AS {c}" for c in rcols])
    return f"""
SELECT {sel} FROM (
  SELECT {key}, nl, nr, unnest(range(1, greatest(nl, nr) + 1)) AS slot FROM (
    SELECT a.{key}, a.n AS nl, COALESCE(b.n, 0) AS nr
    FROM (SELECT {key}, count(*) AS n FROM ({left}) _a GROUP BY 1) a
    LEFT JOIN (SELECT {key}, count(*) AS n FROM ({right}) _b GROUP BY 1) b ON a.{key} = b.{key})) s
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {lo}) AS _p FROM ({left}) _l) l
  ON l.{key} = s.{key} AND l._p = least(s.slot, s.nl)
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ro}) AS _p FROM ({right}) _r) r
  ON r.{key} = s.{key} AND r._p = least(s.slot, s.nr)"""


def zero_pad_sql(expr: str, width: int) -> str:
    v = f"CAST({expr} AS BIGINT)"
    return (f"CASE WHEN {v} < 0 THEN '-' || CASE WHEN length(CAST(abs({v}) AS VARCHAR)) >= {width - 1} "
            f"THEN CAST(abs({v}) AS VARCHAR) ELSE lpad(CAST(abs({v}) AS VARCHAR), {width - 1}, '0') END "
            f"ELSE CASE WHEN length(CAST({v} AS VARCHAR)) >= {width} THEN CAST({v} AS VARCHAR) "
            f"ELSE lpad(CAST({v} AS VARCHAR), {width}, '0') END END")


def render_sql(fields: list[tuple[str, int, int]], lrecl: int | None = None) -> str:
    """Fixed-width line from (expr, start, width) text fields (left aligned)."""
    parts, pos = [], 1
    for expr, start, width in sorted(fields, key=lambda f: f[1]):
        if start > pos:
            parts.append(f"'{' ' * (start - pos)}'")
        parts.append(f"rpad(COALESCE({expr}, ''), {width}, ' ')")
        pos = start + width
    line = " || ".join(parts)
    return f"rpad({line}, {lrecl}, ' ')" if lrecl else line
