"""R-style formulas to named design columns (F1-F6).

Supported: ``y ~ a + C(b) + a:C(b) + a*b + I(a ** 2)``, ``- 1`` / ``+ 0`` to drop
the intercept, ``~ 1`` for the null model.  Categorical factors use treatment
coding with the alphabetically first level as reference when the term's
marginal term is in the model (intercept for main effects, the rest of the
interaction otherwise), else full coding.  Column names follow the usual
``C(b)[T.level]`` and ``a:C(b)[T.level]`` conventions.

The output is a list of ``(name, Column)``: building the design is a
projection; level discovery is one small distinct query per categorical.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Factor:
    kind: str      # "num", "cat" or "expr"
    source: str    # column name or expression text
    label: str     # display name

    @property
    def column(self) -> Column:
        if self.kind == "expr":
            text = re.sub(r"([\w.]+)\s*\*\*\s*([\w.]+)", r"pow(\1, \2)", self.source)
            return F.expr(text).cast("double")
        return F.col(self.source)


def _factor(tok: str) -> Factor:
    tok = tok.strip()
    m = re.fullmatch(r"C\((\w+)\)", tok)
    if m:
        return Factor("cat", m.group(1), tok)
    m = re.fullmatch(r"I\((.*)\)", tok)
    if m:
        return Factor("expr", m.group(1), tok)
    if not re.fullmatch(r"\w+", tok):
        raise ValueError(f"unsupported factor {tok!r}")
    return Factor("num", tok, tok)


def _split_top(text: str, sep: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in text:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == sep and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    out.append(cur)
    return [s.strip() for s in out if s.strip()]


def parse(formula: str) -> tuple[str, list[tuple[Factor, ...]], bool]:
    """``(response, terms, intercept)``; ``a*b`` expands to ``a + b + a:b``."""
    lhs, rhs = formula.split("~", 1)
    intercept = True
    terms: list[tuple[Factor, ...]] = []
    for part in _split_top(rhs.replace("- 1", "+ __noint").replace("-1", "+ __noint"), "+"):
        if part in ("0", "__noint"):
            intercept = False
            continue
        if part == "1":
            continue
        stars = _split_top(part, "*")
        if len(stars) > 1:
            factors = [tuple(_factor(x) for x in _split_top(s, ":")) for s in stars]
            combos: list[tuple[Factor, ...]] = []
            for mask in range(1, 1 << len(factors)):
                t: tuple[Factor, ...] = ()
                for i, f in enumerate(factors):
                    if mask >> i & 1:
                        t = t + f
                combos.append(t)
            combos.sort(key=len)
            for t in combos:
                if t not in terms:
                    terms.append(t)
            continue
        t = tuple(_factor(x) for x in _split_top(part, ":"))
        if t not in terms:
            terms.append(t)
    return lhs.strip(), terms, intercept


def category_levels(df: DataFrame, cols: list[str]) -> dict[str, list]:
    """Sorted distinct non-null values per categorical column, all columns in
    one distinct pass (level sets of categorical factors are small)."""
    if not cols:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    packed = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("e"))
    rows = packed.where(F.col("e.v").isNotNull()).select("e.c", "e.v").distinct().collect()
    out: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        out[r["c"]].append(r["v"])
    for c in cols:
        t = types[c].typeName()
        conv = int if t in ("integer", "long", "short", "byte") else float if t in ("double", "float") else \
            (lambda v: v == "true") if t == "boolean" else str
        out[c] = sorted(conv(v) for v in out[c])
    return out


def _fmt(v) -> str:
    return str(v)


def design_columns(df: DataFrame, formula: str, levels: dict[str, list] | None = None
                   ) -> tuple[str, list[tuple[str, Column]], bool]:
    """Expand ``formula`` into ``(response, [(name, column)], intercept)``.
    The intercept itself is not in the list."""
    response, terms, intercept = parse(formula)
    cats = sorted({f.source for t in terms for f in t if f.kind == "cat"})
    lv = dict(levels or {})
    missing = [c for c in cats if c not in lv]
    if missing:
        lv.update(category_levels(df, missing))
    present = {frozenset(t) for t in terms}
    cols: list[tuple[str, Column]] = []
    for t in terms:
        pieces: list[list[tuple[str, Column]]] = []
        for f in t:
            if f.kind != "cat":
                pieces.append([(f.label, f.column.cast("double"))])
                continue
            rest = frozenset(g for g in t if g != f)
            reduced = (intercept if not rest else rest in present)
            levs = lv[f.source]
            if reduced:
                pieces.append([(f"{f.label}[T.{_fmt(v)}]", (f.column == F.lit(v)).cast("double"))
                               for v in levs[1:]])
            else:
                pieces.append([(f"{f.label}[{_fmt(v)}]", (f.column == F.lit(v)).cast("double"))
                               for v in levs])
        combos: list[tuple[str, Column]] = [("", F.lit(1.0))]
        for p in pieces:
            combos = [((a + ":" + b) if a else b, ca * cb if a else cb) for a, ca in combos for b, cb in p]
        cols += combos
    return response, cols, intercept


def design_frame(df: DataFrame, formula: str, keep: list[str] | None = None,
                 levels: dict[str, list] | None = None) -> tuple[DataFrame, list[str], str, bool]:
    """Materialise the design as columns named after their terms (plus ``keep``)."""
    response, cols, intercept = design_columns(df, formula, levels)
    out = df.select(*(keep or []), F.col(response).cast("double").alias(response),
                    *[c.alias(n) for n, c in cols])
    return out, [n for n, _ in cols], response, intercept
