"""DuckDB reference SQL for every registered query.

Each query is written independently of the Spark code, in plain SQL over the
driver's pre-registered tables, with a straightforward (not scalable) plan:
global sorts, per-fold filters, direct aggregates over the complement rows.
Shared pieces are common table expressions built here.
"""

from __future__ import annotations

from foldwise.functions.scalar import sql_rnd as R

K = 5
SEED = 42


def _congruent(start: str, length: str, j: int, k: int = K) -> str:
    return f"(floor(({start} + {length} - 1 - {j}) / {k}) - floor(({start} - 1 - {j}) / {k}))"


def _strat_case(k: int = K) -> str:
    parts, cum = [], []
    for j in range(k):
        cum.append(_congruent("st", "nc", j, k))
        parts.append(f"WHEN r < {' + '.join(cum)} THEN {j + 1}")
    return "CASE " + " ".join(parts) + " END"


def ctx_ctes(k: int = K, seed: int = SEED) -> str:
    """CTEs: li, raw, ml, kf, kfold, sk0, cls, sfold, ctx, train, test."""
    h = f"md5('{seed}:' || CAST(id AS VARCHAR))"
    return f"""
li AS (
  SELECT l_orderkey, avg(l_quantity) AS avg_qty, avg(l_discount) AS avg_discount, count(*) AS cnt
  FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT o.o_orderkey AS id,
    CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_acctbal END AS acctbal,
    li.avg_qty AS avg_qty,
    li.avg_discount AS avg_discount,
    CAST(coalesce(li.cnt, 0) AS BIGINT) AS n_items,
    CAST(1 AS DOUBLE) AS const_num,
    CAST(2 AS DOUBLE) * (CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_acctbal END) + CAST(1 AS DOUBLE) AS acctbal_copy,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
    o.o_orderpriority AS o_orderpriority,
    n.n_name AS n_name,
    CASE WHEN o.o_orderkey % 211 = 0 THEN 'rare_a' WHEN o.o_orderkey % 307 = 0 THEN 'rare_b' ELSE 'common' END AS rare_cat,
    (o.o_orderkey % 2 = 0) AS is_even,
    o.o_totalprice AS y_reg,
    CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS y_bin
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
ml AS (
  SELECT id, acctbal, avg_qty, avg_discount, n_items, const_num, acctbal_copy, c_mktsegment,
    o_orderpriority, n_name, CASE WHEN rare_cat = 'rare_b' AND id % 5 <> 0 THEN 'common' ELSE rare_cat END AS rare_cat, is_even,
    CASE WHEN id % 5 = 0 THEN NULL ELSE y_reg END AS y_reg,
    CASE WHEN id % 5 = 0 THEN NULL ELSE y_bin END AS y_bin,
    CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM raw),
kf AS (
  SELECT id, row_number() OVER (ORDER BY {h}, id) - 1 AS r, count(*) OVER () AS n
  FROM ml WHERE split = 'train'),
kfold AS (
  SELECT id, CAST(CASE WHEN r < (n % {k}) * (n // {k} + 1) THEN r // (n // {k} + 1)
    ELSE (n % {k}) + (r - (n % {k}) * (n // {k} + 1)) // (n // {k}) END + 1 AS INTEGER) AS fold
  FROM kf),
sk0 AS (
  SELECT id, y_bin, row_number() OVER (PARTITION BY y_bin ORDER BY {h}, id) - 1 AS r,
    count(*) OVER (PARTITION BY y_bin) AS nc
  FROM ml WHERE split = 'train'),
cls AS (
  SELECT y_bin, nc, coalesce(sum(nc) OVER (ORDER BY y_bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
  FROM (SELECT DISTINCT y_bin, nc FROM sk0)),
sfold AS (
  SELECT id, CAST({_strat_case(k)} AS INTEGER) AS sfold
  FROM (SELECT sk0.id, sk0.r, cls.nc, cls.st FROM sk0 JOIN cls ON sk0.y_bin = cls.y_bin)),
ctx AS (
  SELECT ml.*, kfold.fold, sfold.sfold FROM ml LEFT JOIN kfold ON ml.id = kfold.id
  LEFT JOIN sfold ON ml.id = sfold.id),
train AS (SELECT * FROM ctx WHERE split = 'train'),
test AS (SELECT * FROM ctx WHERE split = 'test'),
fits AS (SELECT CAST(range AS INTEGER) AS fit_fold FROM range(1, {k + 1})),
expanded AS (
  SELECT ctx.*, fits.fit_fold,
    CASE WHEN ctx.split = 'test' THEN 'test' WHEN ctx.fold = fits.fit_fold THEN 'valid' ELSE 'train' END AS role
  FROM ctx CROSS JOIN fits)"""


def with_ctx(body: str) -> str:
    return "WITH " + ctx_ctes() + "\n" + body


QUERIES: dict[str, str] = {}


def q(name: str):
    def deco(fn):
        QUERIES[name] = fn()
        return fn
    return deco


@q("folds_kfold")
def _():
    return with_ctx("SELECT id, fold FROM kfold")


@q("folds_stratified")
def _():
    return with_ctx("SELECT s.id, t.y_bin, s.sfold AS fold FROM sfold s JOIN train t ON s.id = t.id")


__all__ = ["QUERIES", "R", "with_ctx"]


# ---------------------------------------------------------------- helpers
NUMERIC = ["acctbal", "avg_qty", "avg_discount", "const_num", "acctbal_copy"]
CATEGORICAL = ["c_mktsegment", "o_orderpriority", "n_name", "rare_cat", "is_even"]
EPS10 = "2.220446049250313e-15"


def lerp(a: str, b: str, t: str) -> str:
    return (f"(CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1 - {t}) "
            f"ELSE {a} + ({b} - {a}) * {t} END)")


def _positions(p: float, method: str):
    if method == "linear":
        h = f"((n - 1) * {p!r})"
        lo = f"floor({h})"
        hi = f"least(floor({h}) + 1, n - 1)"
        t = f"CAST({h} - floor({h}) AS DOUBLE)"
    else:
        g = f"(n * {p!r})"
        j = f"floor({g})"
        lo = f"(CASE WHEN {g} > {j} THEN least({j}, n - 1) ELSE greatest(least({j} - 1, n - 1), 0) END)"
        hi = f"least({j}, n - 1)"
        t = f"(CASE WHEN {g} > {j} THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END)"
    return lo, hi, t


def quantile_cte(name: str, value: str, probs, method: str = "linear", joins: str = "",
                 source: str = "train", fold: str = "fold", fits: str = "fits") -> str:
    """CTE ``name(fit_fold, q0, q1, ...)``: quantiles of ``value`` over the rows of
    ``source`` outside each fit fold, from explicit order statistics."""
    sel = []
    for i, p in enumerate(probs):
        lo, hi, t = _positions(p, method)
        a = f"max(CASE WHEN r = {lo} THEN x END)"
        b = f"max(CASE WHEN r = {hi} THEN x END)"
        sel.append(f"{lerp(a, b, t)} AS q{i}")
    return f"""{name} AS (
  SELECT fit_fold, {', '.join(sel)} FROM (
    SELECT fit_fold, x, row_number() OVER (PARTITION BY fit_fold ORDER BY x) - 1 AS r,
      count(*) OVER (PARTITION BY fit_fold) AS n
    FROM (SELECT fits.fit_fold, {value} AS x FROM {source} s CROSS JOIN {fits} fits {joins}
          WHERE s.{fold} <> fits.fit_fold) WHERE x IS NOT NULL)
  GROUP BY fit_fold, n)"""


def median_ctes(cols=NUMERIC, source: str = "train", fold: str = "fold") -> list[str]:
    return [quantile_cte(f"med_{c}", f"s.{c}", [0.5], source=source, fold=fold) for c in cols]


def imp(c: str, alias: str = "e") -> str:
    return f"coalesce({alias}.{c}, med_{c}.q0)"


def med_joins(cols=NUMERIC, alias: str = "e") -> str:
    return " ".join(f"JOIN med_{c} ON med_{c}.fit_fold = {alias}.fit_fold" for c in cols)


def ctes(*parts: str) -> str:
    return "WITH " + ctx_ctes() + ",\n" + ",\n".join(parts)


# ---------------------------------------------------------------- numeric operators
@q("standardize_cv")
def _():
    mom = []
    for c in NUMERIC:
        mom.append(f"""mom_{c} AS (
  SELECT fits.fit_fold, avg(coalesce(s.{c}, med_{c}.q0)) AS mu, stddev_pop(coalesce(s.{c}, med_{c}.q0)) AS sd
  FROM train s CROSS JOIN fits JOIN med_{c} ON med_{c}.fit_fold = fits.fit_fold
  WHERE s.fold <> fits.fit_fold GROUP BY fits.fit_fold)""")
    cols = ", ".join(
        f"{R(f'({imp(c)} - mom_{c}.mu) / (CASE WHEN mom_{c}.sd < {EPS10} THEN 1 ELSE mom_{c}.sd END)')} "
        f"AS standardize_numeric__{c}" for c in NUMERIC)
    joins = med_joins() + " " + " ".join(f"JOIN mom_{c} ON mom_{c}.fit_fold = e.fit_fold" for c in NUMERIC)
    return ctes(*median_ctes(), *mom) + f"\nSELECT e.id, e.fit_fold, e.role, {cols} FROM expanded e {joins}"


@q("robust_scale_cv")
def _():
    qs = [quantile_cte(f"iq_{c}", f"coalesce(s.{c}, med_{c}.q0)", [0.25, 0.5, 0.75],
                       joins=f"JOIN med_{c} ON med_{c}.fit_fold = fits.fit_fold") for c in NUMERIC]

    def scale(c):
        d = f"(iq_{c}.q2 - iq_{c}.q0)"
        return f"(CASE WHEN {d} < {EPS10} THEN 1 ELSE {d} END)"
    cols = ", ".join(f"{R(f'({imp(c)} - iq_{c}.q1) / {scale(c)}')} AS robust_scale_numeric__{c}" for c in NUMERIC)
    joins = med_joins() + " " + " ".join(f"JOIN iq_{c} ON iq_{c}.fit_fold = e.fit_fold" for c in NUMERIC)
    return ctes(*median_ctes(), *qs) + f"\nSELECT e.id, e.fit_fold, e.role, {cols} FROM expanded e {joins}"


@q("signed_log")
def _():
    cols = ", ".join(f"{R(f'sign({imp(c)}) * ln(1 + abs({imp(c)}))')} AS signed_log_expand_numeric__{c}"
                     for c in NUMERIC)
    return ctes(*median_ctes()) + f"\nSELECT e.id, e.fit_fold, e.role, {cols} FROM expanded e {med_joins()}"


def _edges_cte(c: str, n_bins: int = 5) -> str:
    probs = [i / n_bins for i in range(n_bins + 1)]
    return quantile_cte(f"qe_{c}", f"coalesce(s.{c}, med_{c}.q0)", probs, "averaged_cdf",
                        joins=f"JOIN med_{c} ON med_{c}.fit_fold = fits.fit_fold")


def _bin_expr(c: str, x: str, n_bins: int = 5) -> str:
    """Inner kept edges <= x. Edge i is kept when it exceeds edge i-1 by more
    than 1e-8; a kept edge is inner when some later edge is kept too."""
    keep = {i: f"(qe_{c}.q{i} - qe_{c}.q{i - 1} > 1e-8)" for i in range(1, n_bins + 1)}
    terms = []
    for i in range(1, n_bins):
        later = " OR ".join(keep[j] for j in range(i + 1, n_bins + 1))
        terms.append(f"(CASE WHEN {keep[i]} AND ({later}) AND {x} >= qe_{c}.q{i} THEN 1 ELSE 0 END)")
    return "CAST(" + " + ".join(terms) + " AS INTEGER)"


@q("quantile_bin_long")
def _():
    cols = ", ".join(f"{_bin_expr(c, imp(c))} AS quantile_bin_numeric__{c}" for c in NUMERIC)
    joins = med_joins() + " " + " ".join(f"JOIN qe_{c} ON qe_{c}.fit_fold = e.fit_fold" for c in NUMERIC)
    return ctes(*median_ctes(), *[_edges_cte(c) for c in NUMERIC]) + \
        f"\nSELECT e.id, e.fit_fold, e.role, {cols} FROM expanded e {joins}"


@q("row_missing_count")
def _():
    feats = ["acctbal", "avg_qty", "avg_discount", "n_items", "const_num", "acctbal_copy",
             "c_mktsegment", "o_orderpriority", "n_name", "rare_cat", "is_even"]
    s = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in feats)
    return with_ctx(f"SELECT id, split, CAST({s} AS DOUBLE) AS row_missing_count__value FROM ctx")


def _pair_query(op: str, word: str, fn) -> str:
    import itertools
    cols = []
    for a, b in itertools.combinations(NUMERIC, 2):
        cols.append(f"{R(fn(imp(a), imp(b)))} AS {op}__{a}_{word}_{b}")
    return ctes(*median_ctes()) + f"\nSELECT e.id, e.fit_fold, e.role, {', '.join(cols)} FROM expanded e {med_joins()}"


QUERIES["pair_multiply"] = _pair_query("multiply_numeric_pairs", "x", lambda a, b: f"{a} * {b}")
QUERIES["pair_ratio"] = _pair_query(
    "ratio_numeric_pairs", "over",
    lambda a, b: f"(CASE WHEN {b} + 1e-8 = 0 THEN NULL ELSE {a} / ({b} + 1e-8) END)")
QUERIES["pair_difference"] = _pair_query("difference_numeric_pairs", "minus", lambda a, b: f"{a} - {b}")
QUERIES["pair_sum"] = _pair_query("sum_numeric_pairs", "plus", lambda a, b: f"{a} + {b}")


# ---------------------------------------------------------------- categorical operators
BOOL_COLS = {"is_even"}


def norm(c: str, alias: str = "s") -> str:
    if c in BOOL_COLS:
        return f"coalesce(CASE WHEN {alias}.{c} THEN 'True' WHEN NOT {alias}.{c} THEN 'False' END, '__missing__')"
    return f"coalesce(CAST({alias}.{c} AS VARCHAR), '__missing__')"


def nn(c: str, alias: str = "s") -> str:
    """category text without the missing token (NULL stays NULL)."""
    if c in BOOL_COLS:
        return f"(CASE WHEN {alias}.{c} THEN 'True' WHEN NOT {alias}.{c} THEN 'False' END)"
    return f"CAST({alias}.{c} AS VARCHAR)"


TOT = """tot AS (SELECT fits.fit_fold, count(*) AS n, sum(s.y_reg) AS sy FROM train s CROSS JOIN fits
  WHERE s.fold <> fits.fit_fold GROUP BY fits.fit_fold)"""


def cnt_cte(c: str, name: str | None = None) -> str:
    return f"""{name or 'cnt_' + c} AS (SELECT fits.fit_fold, {norm(c)} AS v, count(*) AS n, sum(s.y_reg) AS sy
  FROM train s CROSS JOIN fits WHERE s.fold <> fits.fit_fold GROUP BY 1, 2)"""


@q("frequency_encode_cv")
def _():
    cols = ", ".join(f"{R(f'coalesce(CAST(cnt_{c}.n AS DOUBLE) / tot.n, 0)')} AS frequency_encode_categoricals__{c}"
                     for c in CATEGORICAL)
    joins = "JOIN tot ON tot.fit_fold = e.fit_fold " + " ".join(
        f"LEFT JOIN cnt_{c} ON cnt_{c}.fit_fold = e.fit_fold AND cnt_{c}.v = {norm(c, 'e')}" for c in CATEGORICAL)
    return ctes(TOT, *[cnt_cte(c) for c in CATEGORICAL]) + \
        f"\nSELECT e.id, e.fit_fold, e.role, {cols} FROM expanded e {joins}"


@q("target_encode_cv")
def _():
    gm = "(tot.sy / tot.n)"
    cols = ", ".join(
        f"{R(f'coalesce((cnt_{c}.sy + 1.0 * {gm}) / (cnt_{c}.n + 1.0), {gm})', 1)} AS target_encode_categoricals__{c}"
        for c in CATEGORICAL)
    joins = "JOIN tot ON tot.fit_fold = e.fit_fold " + " ".join(
        f"LEFT JOIN cnt_{c} ON cnt_{c}.fit_fold = e.fit_fold AND cnt_{c}.v = {norm(c, 'e')}" for c in CATEGORICAL)
    return ctes(TOT, *[cnt_cte(c) for c in CATEGORICAL]) + \
        f"\nSELECT e.id, e.fit_fold, e.role, {cols} FROM expanded e {joins}"


def mode_ctes(c: str) -> list[str]:
    return [f"""nn_{c} AS (SELECT fits.fit_fold, {nn(c)} AS v, count(*) AS n FROM train s CROSS JOIN fits
  WHERE s.fold <> fits.fit_fold AND s.{c} IS NOT NULL GROUP BY 1, 2)""",
            f"""mode_{c} AS (SELECT fit_fold, v FROM (SELECT fit_fold, v, row_number() OVER
  (PARTITION BY fit_fold ORDER BY n DESC, v) AS rn FROM nn_{c}) WHERE rn = 1)""",
            f"""idx_{c} AS (SELECT fit_fold, v, row_number() OVER (PARTITION BY fit_fold ORDER BY v) - 1 AS ix
  FROM nn_{c})"""]


@q("ordinal_encode_cv")
def _():
    parts, cols, joins = [], [], []
    for c in CATEGORICAL:
        parts += mode_ctes(c)
        cols.append(f"CAST(CASE WHEN e.{c} IS NULL THEN mi_{c}.ix ELSE coalesce(idx_{c}.ix, -1) END AS DOUBLE)"
                    f" AS ordinal_encode_categoricals__{c}")
        joins.append(f"JOIN mode_{c} ON mode_{c}.fit_fold = e.fit_fold "
                     f"JOIN idx_{c} mi_{c} ON mi_{c}.fit_fold = e.fit_fold AND mi_{c}.v = mode_{c}.v "
                     f"LEFT JOIN idx_{c} ON idx_{c}.fit_fold = e.fit_fold AND idx_{c}.v = {nn(c, 'e')}")
    return ctes(*parts) + f"\nSELECT e.id, e.fit_fold, e.role, {', '.join(cols)} FROM expanded e {' '.join(joins)}"


@q("onehot_long")
def _():
    op = "onehot_encode_low_cardinality_categoricals"
    parts, sels = [], []
    for c in CATEGORICAL:
        parts += mode_ctes(c)
        vimp = f"coalesce({nn(c, 'e')}, mode_{c}.v)"
        sels.append(f"""SELECT e.id, e.fit_fold, e.role, '{op}__{c}_' || {vimp} AS feature, CAST(1 AS DOUBLE) AS value
  FROM expanded e JOIN mode_{c} ON mode_{c}.fit_fold = e.fit_fold
  LEFT JOIN nn_{c} ON nn_{c}.fit_fold = e.fit_fold AND nn_{c}.v = {vimp}
  WHERE nn_{c}.v IS NOT NULL AND (SELECT count(DISTINCT {nn(c, 't')}) FROM train t) <= 16""")
    return ctes(*parts) + "\n" + "\nUNION ALL\n".join(sels)


@q("rare_bucket_long")
def _():
    op = "rare_category_bucket"
    sels = []
    for c in CATEGORICAL:
        sels.append(f"""SELECT e.id, e.fit_fold, e.role, '{op}__{c}_' || {norm(c, 'e')} AS feature, CAST(1 AS DOUBLE) AS value
  FROM expanded e JOIN tot ON tot.fit_fold = e.fit_fold
  JOIN cnt_{c} ON cnt_{c}.fit_fold = e.fit_fold AND cnt_{c}.v = {norm(c, 'e')}
  WHERE CAST(cnt_{c}.n AS DOUBLE) / tot.n < 0.04""")
    return ctes(TOT, *[cnt_cte(c) for c in CATEGORICAL]) + "\n" + "\nUNION ALL\n".join(sels)


# ---------------------------------------------------------------- interactions and pruning
import itertools as _it  # noqa: E402


def nu_cte() -> str:
    cols = ", ".join(f"count(DISTINCT {nn(c)}) AS u_{c}" for c in CATEGORICAL)
    return f"nu AS (SELECT fits.fit_fold, {cols} FROM train s CROSS JOIN fits WHERE s.fold <> fits.fit_fold GROUP BY 1)"


def xv(a: str, b: str, alias: str = "s") -> str:
    return f"({norm(a, alias)} || '__x__' || {norm(b, alias)})"


def xc_cte(a: str, b: str) -> str:
    return f"""xc_{a}_{b} AS (SELECT fits.fit_fold, {xv(a, b)} AS v, count(*) AS n FROM train s CROSS JOIN fits
  WHERE s.fold <> fits.fit_fold GROUP BY 1, 2)"""


PAIRS = list(_it.combinations(CATEGORICAL, 2))


@q("cross_cat_long")
def _():
    op = "cross_low_cardinality_categoricals"
    sels = [f"""SELECT e.id, e.fit_fold, e.role, '{op}__{op}__{a}__x__{b}_' || {xv(a, b, 'e')} AS feature,
  CAST(1 AS DOUBLE) AS value FROM expanded e JOIN nu ON nu.fit_fold = e.fit_fold
  JOIN xc_{a}_{b} x ON x.fit_fold = e.fit_fold AND x.v = {xv(a, b, 'e')}
  WHERE nu.u_{a} <= 10 AND nu.u_{b} <= 10""" for a, b in PAIRS]
    return ctes(nu_cte(), *[xc_cte(a, b) for a, b in PAIRS]) + "\n" + "\nUNION ALL\n".join(sels)


@q("frequency_cross_cv")
def _():
    op = "frequency_encode_categorical_crosses"
    sels = [f"""SELECT e.id, e.fit_fold, e.role, '{op}__{a}__x__{b}' AS feature,
  {R(f'coalesce(CAST(x.n AS DOUBLE) / tot.n, 0)')} AS value
  FROM expanded e JOIN nu ON nu.fit_fold = e.fit_fold JOIN tot ON tot.fit_fold = e.fit_fold
  LEFT JOIN xc_{a}_{b} x ON x.fit_fold = e.fit_fold AND x.v = {xv(a, b, 'e')}
  WHERE nu.u_{a} <= 10 AND nu.u_{b} <= 10""" for a, b in PAIRS]
    return ctes(TOT, nu_cte(), *[xc_cte(a, b) for a, b in PAIRS]) + "\n" + "\nUNION ALL\n".join(sels)


def _bin_of(c: str, x: str) -> str:
    return _bin_expr(c, x)


@q("cross_bin_long")
def _():
    op = "cross_categorical_with_binned_numeric"
    parts = [nu_cte(), *median_ctes(), *[_edges_cte(c) for c in NUMERIC]]
    sels = []
    for x in NUMERIC:
        for c in CATEGORICAL:
            parts.append(f"""xb_{x}_{c} AS (SELECT DISTINCT fits.fit_fold, {_bin_of(x, imp(x, 's'))} AS b, {norm(c)} AS v
  FROM train s CROSS JOIN fits JOIN med_{x} ON med_{x}.fit_fold = fits.fit_fold
  JOIN qe_{x} ON qe_{x}.fit_fold = fits.fit_fold WHERE s.fold <> fits.fit_fold)""")
            b = _bin_of(x, imp(x))
            sels.append(f"""SELECT e.id, e.fit_fold, e.role,
  '{op}__{op}__{x}__x__{c}_bin_' || CAST({b} AS VARCHAR) || '__x__' || {norm(c, 'e')} AS feature,
  CAST(1 AS DOUBLE) AS value
  FROM expanded e JOIN nu ON nu.fit_fold = e.fit_fold JOIN med_{x} ON med_{x}.fit_fold = e.fit_fold
  JOIN qe_{x} ON qe_{x}.fit_fold = e.fit_fold
  JOIN xb_{x}_{c} xb ON xb.fit_fold = e.fit_fold AND xb.b = {b} AND xb.v = {norm(c, 'e')}
  WHERE nu.u_{c} <= 10""")
    return ctes(*parts) + "\n" + "\nUNION ALL\n".join(sels)


@q("group_deviation_cv")
def _():
    op = "groupwise_deviation_features"
    parts = [nu_cte(), *median_ctes()]
    for x in NUMERIC:
        parts.append(f"""gl_{x} AS (SELECT fits.fit_fold, avg({imp(x, 's')}) AS mu, stddev_samp({imp(x, 's')}) AS sd
  FROM train s CROSS JOIN fits JOIN med_{x} ON med_{x}.fit_fold = fits.fit_fold
  WHERE s.fold <> fits.fit_fold GROUP BY 1)""")
    sels = []
    for x in NUMERIC:
        for c in CATEGORICAL:
            parts.append(f"""gd_{x}_{c} AS (SELECT fits.fit_fold, {norm(c)} AS v, avg({imp(x, 's')}) AS mu,
  coalesce(stddev_samp({imp(x, 's')}), 0) AS sd
  FROM train s CROSS JOIN fits JOIN med_{x} ON med_{x}.fit_fold = fits.fit_fold
  WHERE s.fold <> fits.fit_fold GROUP BY 1, 2)""")
            mean = f"coalesce(g.mu, gl_{x}.mu)"
            sd = f"(CASE WHEN g.v IS NULL THEN gl_{x}.sd ELSE g.sd END)"
            sels.append(f"""SELECT e.id, e.fit_fold, e.role, '{op}__{x}_dev_by_{c}' AS feature,
  {R(f'({imp(x)} - {mean}) / ({sd} + 1e-8)')} AS value
  FROM expanded e JOIN nu ON nu.fit_fold = e.fit_fold JOIN med_{x} ON med_{x}.fit_fold = e.fit_fold
  JOIN gl_{x} ON gl_{x}.fit_fold = e.fit_fold
  LEFT JOIN gd_{x}_{c} g ON g.fit_fold = e.fit_fold AND g.v = {norm(c, 'e')}
  WHERE nu.u_{c} <= 20""")
    return ctes(*parts) + "\n" + "\nUNION ALL\n".join(sels)


@q("high_corr_prune")
def _():
    feats = [f"standardize_numeric__{c}" for c in NUMERIC] + [f"frequency_encode_categoricals__{c}" for c in CATEGORICAL]
    mom = [f"""mom_{c} AS (
  SELECT fits.fit_fold, avg(coalesce(s.{c}, med_{c}.q0)) AS mu, stddev_pop(coalesce(s.{c}, med_{c}.q0)) AS sd
  FROM train s CROSS JOIN fits JOIN med_{c} ON med_{c}.fit_fold = fits.fit_fold
  WHERE s.fold <> fits.fit_fold GROUP BY fits.fit_fold)""" for c in NUMERIC]
    fcols = [f"({imp(c)} - mom_{c}.mu) / (CASE WHEN mom_{c}.sd < {EPS10} THEN 1 ELSE mom_{c}.sd END) AS f{i}"
             for i, c in enumerate(NUMERIC)]
    fcols += [f"coalesce(CAST(cnt_{c}.n AS DOUBLE) / tot.n, 0) AS f{i + len(NUMERIC)}" for i, c in enumerate(CATEGORICAL)]
    joins = (med_joins() + " " + " ".join(f"JOIN mom_{c} ON mom_{c}.fit_fold = e.fit_fold" for c in NUMERIC)
             + " JOIN tot ON tot.fit_fold = e.fit_fold " + " ".join(
                 f"LEFT JOIN cnt_{c} ON cnt_{c}.fit_fold = e.fit_fold AND cnt_{c}.v = {norm(c, 'e')}" for c in CATEGORICAL))
    block = f"block AS (SELECT e.fit_fold, {', '.join(fcols)} FROM expanded e {joins} WHERE e.role = 'train')"
    d = len(feats)
    cor = ", ".join(f"corr(f{i}, f{j}) AS c_{i}_{j}" for i in range(d) for j in range(i + 1, d))
    cm = f"cm AS (SELECT fit_fold, {cor} FROM block GROUP BY fit_fold)"

    def big(i, j):
        c = f"c_{i}_{j}"
        return f"coalesce(CASE WHEN isnan({c}) THEN NULL ELSE abs({c}) > 0.98 END, false)"
    sels = []
    for j, name in enumerate(feats):
        cond = " OR ".join(big(i, j) for i in range(j)) or "false"
        sels.append(f"SELECT fit_fold, '{name}' AS feature, CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER) AS dropped FROM cm")
    return ctes(*median_ctes(), *mom, TOT, *[cnt_cte(c) for c in CATEGORICAL], block, cm) + "\n" + "\nUNION ALL\n".join(sels)


# ---------------------------------------------------------------- profiles
TRAIN_COLS = ["id", "acctbal", "avg_qty", "avg_discount", "n_items", "const_num", "acctbal_copy",
              "c_mktsegment", "o_orderpriority", "n_name", "rare_cat", "is_even", "y_reg"]
TEST_COLS = TRAIN_COLS[:-1]
SPARK_TYPES = {"id": "bigint", "n_items": "bigint", "c_mktsegment": "string", "o_orderpriority": "string",
               "n_name": "string", "rare_cat": "string", "is_even": "boolean"}
NON_NUMBER = ["c_mktsegment", "o_orderpriority", "n_name", "rare_cat", "is_even"]


def _col_stats(table: str, cols, dataset: str | None = None, with_dtype: bool = False) -> str:
    sels = []
    for c in cols:
        ds = f"'{dataset}' AS dataset, " if dataset else ""
        dt = f"'{SPARK_TYPES.get(c, 'double')}' AS dtype, " if with_dtype else ""
        sels.append(f"""SELECT {ds}'{c}' AS column, {dt}CAST(count(*) - count({c}) AS BIGINT) AS null_count,
  {R(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*)', 9)} AS null_pct,
  CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nunique
  FROM {table}""")
    return "\nUNION ALL\n".join(sels)


@q("column_summary")
def _():
    return with_ctx(_col_stats("train", TRAIN_COLS, with_dtype=True))


@q("missingness")
def _():
    sels = []
    for ds, cols in (("train", TRAIN_COLS), ("test", TEST_COLS)):
        for c in cols:
            sels.append(f"""SELECT '{ds}' AS dataset, '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS null_count,
  {R(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*)', 9)} AS null_pct FROM {ds}""")
    return with_ctx("\nUNION ALL\n".join(sels))


@q("cardinality")
def _():
    return with_ctx(_col_stats("train", NON_NUMBER, "train") + "\nUNION ALL\n" + _col_stats("test", NON_NUMBER, "test"))


@q("target_summary_numeric")
def _():
    qc = quantile_cte("tq", "s.y_reg", [0.25, 0.5, 0.75], fits="(SELECT 0 AS fit_fold)")
    body = f"""SELECT 'count' AS metric, {R('CAST(count(y_reg) AS DOUBLE)', 4)} AS value FROM train
UNION ALL SELECT 'mean', {R('avg(y_reg)', 4)} FROM train
UNION ALL SELECT 'std', {R('stddev_samp(y_reg)', 4)} FROM train
UNION ALL SELECT 'min', {R('min(y_reg)', 4)} FROM train
UNION ALL SELECT '25%', {R('q0', 4)} FROM tq
UNION ALL SELECT '50%', {R('q1', 4)} FROM tq
UNION ALL SELECT '75%', {R('q2', 4)} FROM tq
UNION ALL SELECT 'max', {R('max(y_reg)', 4)} FROM train"""
    return ctes(qc) + "\n" + body


@q("target_summary_categorical")
def _():
    return with_ctx(f"""SELECT 'value_' || coalesce(CAST(y_bin AS VARCHAR), 'nan') || '_count' AS metric,
  CAST(count(*) AS DOUBLE) AS value FROM train GROUP BY y_bin
UNION ALL
SELECT 'value_' || coalesce(CAST(y_bin AS VARCHAR), 'nan') || '_ratio',
  {R('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM train)', 9)} FROM train GROUP BY y_bin""")


@q("feature_types")
def _():
    feats = TRAIN_COLS[1:-1]
    ni = ("(CASE WHEN (SELECT count(DISTINCT n_items) FROM train) <= 20 AND "
          "(SELECT count(*) FROM train WHERE n_items IS NULL) = 0 THEN 'categorical' ELSE 'numeric' END)")
    kinds = {c: ("'numeric'" if SPARK_TYPES.get(c, "double") in ("double", "bigint") else "'categorical'")
             for c in feats}
    kinds["n_items"] = ni
    rows = "\nUNION ALL\n".join(f"SELECT '{c}' AS column, {kinds[c]} AS feature_type" for c in feats)
    body = f"""ft AS ({rows})
SELECT "column", feature_type FROM ft
UNION ALL SELECT '__count_numeric', CAST(count(*) FILTER (WHERE feature_type = 'numeric') AS VARCHAR) FROM ft
UNION ALL SELECT '__count_categorical', CAST(count(*) FILTER (WHERE feature_type = 'categorical') AS VARCHAR) FROM ft
UNION ALL SELECT '__count_total', CAST(count(*) AS VARCHAR) FROM ft"""
    return ctes(body)


@q("run_summary")
def _():
    sels = []
    for ds, cols in (("train", TRAIN_COLS), ("test", TEST_COLS)):
        miss = " + ".join(f"CAST(count(*) - count({c}) AS DOUBLE) / count(*)" for c in cols)
        collist = ", ".join(cols)
        sels += [f"SELECT '{ds}_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM {ds}",
                 f"SELECT '{ds}_cols', CAST({len(cols)} AS DOUBLE)",
                 f"SELECT '{ds}_missing_pct', {R(f'({miss}) / {len(cols)}', 9)} FROM {ds}",
                 f"SELECT '{ds}_duplicate_rows', CAST((SELECT count(*) FROM {ds}) - "
                 f"(SELECT count(*) FROM (SELECT DISTINCT {collist} FROM {ds})) AS DOUBLE)"]
    sels.append("SELECT 'model_feature_count', CAST(11 AS DOUBLE)")
    return with_ctx("\nUNION ALL\n".join(sels))


@q("target_stats_regression")
def _():
    return with_ctx(f"SELECT {R('avg(y_reg)', 4)} AS mean, {R('stddev_pop(y_reg)', 4)} AS std, "
                    f"{R('min(y_reg)', 4)} AS min, {R('max(y_reg)', 4)} AS max FROM train")


@q("target_stats_binary")
def _():
    return with_ctx(f"SELECT count(*) FILTER (WHERE y_bin = 1) AS positive_count, "
                    f"count(*) FILTER (WHERE y_bin <> 1) AS negative_count, "
                    f"{R('avg(CAST(y_bin = 1 AS DOUBLE))', 9)} AS prevalence FROM train")


# ---------------------------------------------------------------- metrics
def D(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _r1(x: str) -> str:
    return f"(floor(({x}) * {D(10.0)} + {D(0.5)}) / {D(10.0)})"


def _clip01(x: str) -> str:
    return f"least(greatest({x}, {D(0.0)}), {D(1.0)})"


REG_CANDIDATES = [
    ("cand_a", f"y + (id % 97 - 48) * {D(10.0)}"),
    ("cand_b", f"y + (id % 89 - 44) * {D(12.0)}"),
    ("cand_c", f"y * {D(0.9)} + {D(15000.0)} + (id % 13 - 6) * {D(100.0)}"),
    ("cand_d", f"{D(300000.0)} - y + (id % 7 - 3) * {D(50.0)}"),
    ("cand_e", f"y + (id % 97 - 48) * {D(10.0)} + {D(0.5)}"),
]
_dd = f"(CAST(y AS DOUBLE) - {D(0.5)})"
BIN_CANDIDATES = [
    ("bin_a", _r1(_clip01(f"({D(0.5)} + {_dd} * {D(0.4)}) + (id % 11 - 5) * {D(0.06)}"))),
    ("bin_b", _r1(_clip01(f"({D(0.5)} + {_dd} * {D(0.2)}) + (id % 7 - 3) * {D(0.1)}"))),
    ("bin_c", _r1(_clip01(f"({D(0.5)} - {_dd} * {D(0.3)}) + (id % 5 - 2) * {D(0.1)}"))),
]


def oof_ctes() -> list[str]:
    out = []
    for name, label, fold, cands in (("oof", "y_reg", "fold", REG_CANDIDATES),
                                     ("oofb", "y_bin", "sfold", BIN_CANDIDATES)):
        out.append(f"""{name}_base AS (SELECT row_number() OVER (ORDER BY id) - 1 AS row_idx, id,
  {label} AS y, {fold} AS fold FROM train)""")
        sels = [f"SELECT row_idx, id, CAST(y AS DOUBLE) AS y_true, fold, '{c}' AS candidate_id, "
                f"CAST({e} AS DOUBLE) AS y_pred FROM {name}_base" for c, e in cands]
        out.append(f"{name} AS (" + "\nUNION ALL\n".join(sels) + ")")
    return out


METRIC_SQL = {
    "rmse": "sqrt(avg((y_true - y_pred) * (y_true - y_pred)))",
    "mse": "avg((y_true - y_pred) * (y_true - y_pred))",
    "mae": "CAST(sum(CAST(abs(y_true - y_pred) AS DECIMAL(28, 4))) AS DOUBLE) / count(*)",
    "rmsle": "sqrt(avg((ln(1 + y_true) - ln(1 + greatest(y_pred, 0))) * (ln(1 + y_true) - ln(1 + greatest(y_pred, 0)))))",
    "log_loss": ("-avg(y_true * ln(least(greatest(y_pred, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) + "
                 "(1 - y_true) * ln(1 - least(greatest(y_pred, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))"),
    "accuracy": "avg(CAST((y_pred >= 0.5) = (y_true = 1) AS DOUBLE))",
}


def _fold_metric_sql(src: str, metric: str, digits: int) -> str:
    return ctes(*oof_ctes()) + f"""
SELECT candidate_id, fold, '{metric}' AS metric_name, {R(METRIC_SQL[metric], digits)} AS metric_value,
  count(*) AS valid_rows, CAST(sum(count(*)) OVER (PARTITION BY candidate_id) - count(*) AS BIGINT) AS train_rows
FROM {src} GROUP BY candidate_id, fold"""


for _m, _d in (("rmse", 4), ("mse", 1), ("mae", 4), ("rmsle", 4)):
    QUERIES[f"metric_{_m}"] = _fold_metric_sql("oof", _m, _d)
QUERIES["metric_logloss"] = _fold_metric_sql("oofb", "log_loss", 9)
QUERIES["metric_accuracy"] = _fold_metric_sql("oofb", "accuracy", 9)

AUC_CTE = """auc_s AS (SELECT candidate_id, fold, y_pred AS score, sum(y_true) AS pos, sum(1 - y_true) AS neg
  FROM oofb GROUP BY 1, 2, 3),
auc_r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY candidate_id, fold ORDER BY score
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM auc_s),
auc AS (SELECT candidate_id, fold, sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) AS v,
  CAST(sum(pos + neg) AS BIGINT) AS valid_rows FROM auc_r GROUP BY 1, 2)"""


@q("metric_auc")
def _():
    return ctes(*oof_ctes(), AUC_CTE) + f"""
SELECT candidate_id, fold, 'roc_auc' AS metric_name, {R('v', 9)} AS metric_value, valid_rows,
  CAST(sum(valid_rows) OVER (PARTITION BY candidate_id) - valid_rows AS BIGINT) AS train_rows FROM auc"""


@q("cv_summary")
def _():
    return ctes(*oof_ctes(), AUC_CTE) + f"""
, fm AS (SELECT candidate_id, fold, 'rmse' AS metric_name, {METRIC_SQL['rmse']} AS v FROM oof GROUP BY 1, 2
  UNION ALL SELECT candidate_id, fold, 'roc_auc', v FROM auc)
SELECT candidate_id, metric_name, {R('avg(v)', 6)} AS cv_mean, {R('stddev_pop(v)', 6)} AS cv_std,
  count(*) AS n_folds FROM fm GROUP BY 1, 2"""


# ---------------------------------------------------------------- blending
@q("blend_weighted")
def _():
    return ctes(*oof_ctes()) + f"""
, w AS (SELECT * FROM (VALUES ('cand_a', {D(0.5)}), ('cand_b', {D(0.25)}), ('cand_c', {D(0.25)})) t(candidate_id, w))
SELECT row_idx, id, y_true, fold, {R('sum(w.w * oof.y_pred) / sum(w.w)', 6)} AS y_pred, count(*) AS n_components
FROM oof JOIN w ON oof.candidate_id = w.candidate_id GROUP BY row_idx, id, y_true, fold"""


@q("blend_labels")
def _():
    return ctes(*oof_ctes()) + f"""
, w AS (SELECT * FROM (VALUES ('bin_a', {D(0.5)}), ('bin_b', {D(0.5)})) t(candidate_id, w)),
b AS (SELECT row_idx, id, sum(w.w * oofb.y_pred) / sum(w.w) AS p FROM oofb JOIN w ON oofb.candidate_id = w.candidate_id
  GROUP BY row_idx, id)
SELECT row_idx, id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS label, {R('p', 9)} AS probability FROM b"""


@q("oof_correlation")
def _():
    cands = [c for c, _ in REG_CANDIDATES]
    piv = ", ".join(f"max(CASE WHEN candidate_id = '{c}' THEN y_pred END) AS {c}" for c in cands)
    sels = []
    for i, a in enumerate(cands):
        for b in cands[i + 1:]:
            sels.append(f"SELECT '{a}' AS candidate_a, '{b}' AS candidate_b, {R(f'corr({a}, {b})', 9)} AS corr FROM wd")
    return ctes(*oof_ctes()) + f"\n, wd AS (SELECT row_idx, {piv} FROM oof GROUP BY row_idx)\n" + "\nUNION ALL\n".join(sels)


# ---------------------------------------------------------------- contracts
def _sub_ctes(kind: str) -> list[str]:
    label = "y_reg" if kind == "regression" else "y_bin"
    if kind == "regression":
        value = (f"CASE WHEN id % 65 = 0 THEN NULL WHEN id % 85 = 0 THEN CAST('inf' AS DOUBLE) "
                 f"ELSE {D(150000.0)} + (id % 1000) * {D(10.0)} END")
        extra = D(1.0)
    elif kind == "probability":
        value = f"CASE WHEN id % 65 = 0 THEN NULL ELSE (id % 23) / {D(20.0)} END"
        extra = D(0.5)
    else:
        value = "CAST(CASE WHEN id % 65 = 0 THEN NULL ELSE id % 3 END AS INTEGER)"
        extra = "CAST(1 AS INTEGER)"
    return [f"tmpl AS (SELECT id FROM test)",
            f"""pred AS (SELECT id, {value} AS {label} FROM test WHERE id % 35 <> 0
  UNION ALL SELECT id, {extra} FROM test WHERE id % 45 = 0
  UNION ALL SELECT id + 1, {extra} FROM test WHERE id % 55 = 0)"""]


def _violations(kind: str) -> str:
    label = "y_reg" if kind == "regression" else "y_bin"
    p = f"pred.{label}"
    rows = [f"SELECT 'null_predictions' AS \"check\", CAST(count(*) FILTER (WHERE {p} IS NULL) AS BIGINT) AS violations FROM pred"]
    if kind in ("regression", "probability"):
        rows.append(f"SELECT 'non_finite_predictions', CAST(count(*) FILTER (WHERE {p} IS NOT NULL AND NOT isfinite({p})) AS BIGINT) FROM pred")
    if kind == "probability":
        rows.append(f"SELECT 'out_of_range', CAST(count(*) FILTER (WHERE isfinite({p}) AND ({p} < 0 OR {p} > 1)) AS BIGINT) FROM pred")
    if kind == "label":
        rows.append(f"SELECT 'unknown_labels', CAST(count(*) FILTER (WHERE {p} IS NOT NULL AND CAST({p} AS VARCHAR) NOT IN ('0', '1')) AS BIGINT) FROM pred")
    rows += [
        "SELECT 'duplicate_ids', CAST(count(*) AS BIGINT) FROM (SELECT id FROM pred GROUP BY id HAVING count(*) > 1)",
        "SELECT 'missing_ids', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT id FROM tmpl WHERE id NOT IN (SELECT id FROM pred))",
        "SELECT 'unknown_ids', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT id FROM pred WHERE id NOT IN (SELECT id FROM tmpl))",
        "SELECT 'row_count_mismatch', CAST(abs((SELECT count(*) FROM pred) - (SELECT count(*) FROM tmpl)) AS BIGINT)",
        "SELECT 'column_mismatch', CAST(0 AS BIGINT)",
    ]
    return ctes(*_sub_ctes(kind)) + "\n" + "\nUNION ALL\n".join(rows)


QUERIES["submission_violations"] = _violations("regression")
QUERIES["violation_previews"] = ctes(*_sub_ctes("regression")) + """
, bad AS (SELECT 'duplicate_ids' AS "check", id FROM pred GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT 'missing_ids', id FROM (SELECT DISTINCT id FROM tmpl WHERE id NOT IN (SELECT id FROM pred))
  UNION ALL SELECT 'unknown_ids', id FROM (SELECT DISTINCT id FROM pred WHERE id NOT IN (SELECT id FROM tmpl)))
SELECT "check", CAST(position AS INTEGER) AS position, CAST(id AS VARCHAR) AS id FROM (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY id) AS position FROM bad) WHERE position <= 10"""
QUERIES["probability_contracts"] = """
SELECT 'cand_' || p_partkey AS candidate_id, CASE WHEN p_partkey % 23 = 0 THEN 'unreadable' WHEN p_partkey % 13 = 0 OR (p_partkey % 19 = 0 AND p_partkey % 17 <> 0) THEN 'missing_contract'
  WHEN p_partkey % 11 = 0 THEN 'rule_mismatch' WHEN p_partkey % 17 = 0 THEN 'label_mismatch' ELSE 'ok' END AS contract FROM part"""
QUERIES["event_ids"] = """
SELECT event_id, 'sub_' || strftime(ts, '%Y%m%dt%H%M%S%f') || '_' || left(md5(event_id::VARCHAR || '|' || coalesce(user_id::VARCHAR, '')), 6) AS submission_event_id FROM events"""
QUERIES["probability_violations"] = _violations("probability")
QUERIES["label_violations"] = _violations("label")


# ---------------------------------------------------------------- run ledger
REQ_PATHS = ["logs/runtime.log", "config/runtime_config.json", "context/competition.json", "context/folds.csv",
             "candidate/candidate.json", "candidate/fold_metrics.csv", "candidate/oof_predictions.csv",
             "candidate/test_predictions.csv"]


def ledger_ctes() -> list[str]:
    paths = ", ".join(f"({j}, '{p}')" for j, p in enumerate(REQ_PATHS + ["extra/notes.txt"]))
    req = ", ".join(f"'{p}'" for p in REQ_PATHS)
    return [f"""runs AS (SELECT 'run_' || CAST(p_partkey AS VARCHAR) AS run_id,
  'cand_' || replace(p_brand, 'Brand#', '') AS candidate_id, lower(p_type) AS family,
  split_part(p_name, ' ', 1) AS recipe,
  CASE p_size % 4 WHEN 0 THEN 'screening' WHEN 1 THEN 'canonical' WHEN 2 THEN 'submission' ELSE 'optimization_trial' END AS run_kind,
  CASE WHEN p_partkey % 10 = 0 THEN 'FAILED' WHEN p_partkey % 10 = 1 THEN 'RUNNING'
       WHEN p_partkey % 10 = 2 THEN 'SCHEDULED' ELSE 'FINISHED' END AS status,
  CASE WHEN p_size % 2 = 0 THEN 'cpu' ELSE 'gpu' END AS variant,
  p_retailprice / {D(1000.0)} AS metric_value,
  CASE WHEN p_size % 4 = 3 THEN 'run_' || CAST(p_partkey - p_partkey % 16 AS VARCHAR) END AS parent_run_id,
  CASE WHEN p_size % 4 = 3 THEN CAST(p_partkey % 16 AS INTEGER) END AS trial_number,
  CASE WHEN p_size % 3 = 0 THEN '3' ELSE '5' END AS cv_n_splits, 'true' AS cv_shuffle, '42' AS cv_random_state
FROM part)""",
            f"""arts AS (SELECT 'run_' || CAST(p_partkey AS VARCHAR) AS run_id, t.path FROM part
  CROSS JOIN (VALUES {paths}) t(j, path) WHERE (p_partkey + t.j) % 13 <> 0 OR t.j = 8)""",
            f"""inc AS (SELECT r.run_id FROM runs r LEFT JOIN (SELECT run_id, count(DISTINCT path) AS n FROM arts
  WHERE path IN ({req}) GROUP BY run_id) a ON r.run_id = a.run_id WHERE coalesce(a.n, 0) < 8)""",
            """can AS (SELECT * FROM runs WHERE run_kind = 'canonical' AND status = 'FINISHED'
  AND run_id NOT IN (SELECT run_id FROM inc))""",
            """lookup AS (SELECT c.candidate_id, CAST(coalesce(per.n, 0) AS BIGINT) AS n_canonical,
  CAST(coalesce(act.n, 0) AS BIGINT) AS n_active,
  CASE WHEN coalesce(per.n, 0) = 0 THEN 'missing' WHEN per.n = 1 THEN 'ok' ELSE 'ambiguous' END AS lookup_status,
  CASE WHEN per.n = 1 THEN per.run_id END AS run_id
  FROM (SELECT DISTINCT candidate_id FROM runs) c
  LEFT JOIN (SELECT candidate_id, count(*) AS n, min(run_id) AS run_id FROM can GROUP BY 1) per ON per.candidate_id = c.candidate_id
  LEFT JOIN (SELECT candidate_id, count(*) AS n FROM runs WHERE run_kind = 'canonical'
    AND status IN ('RUNNING', 'SCHEDULED') GROUP BY 1) act ON act.candidate_id = c.candidate_id)"""]


def lctes(*more: str) -> str:
    return "WITH " + ",\n".join(ledger_ctes() + list(more))


QUERIES["canonical_runs"] = lctes() + "\nSELECT * FROM lookup"
QUERIES["canonical_manifests"] = lctes("""manifest AS (SELECT run_id, CASE WHEN k % 19 = 0 THEN left(t, 25) WHEN k % 23 = 0 THEN '[' || t || ']' ELSE t END AS text FROM (
  SELECT run_id, CAST(substr(run_id, 5) AS BIGINT) AS k, '{"candidate_id": "' || CASE WHEN CAST(substr(run_id, 5) AS BIGINT) % 29 = 0 THEN 'cand_0' ELSE candidate_id END
    || '", "cv": {"n_splits": ' || CASE WHEN CAST(substr(run_id, 5) AS BIGINT) % 31 = 0 THEN '"many"' ELSE cv_n_splits END || '}}' AS t FROM runs))""") + """
SELECT c.run_id, c.candidate_id, TRY_CAST(json_extract(m.text, '$.cv.n_splits') AS INTEGER) AS n_splits
FROM can c JOIN (SELECT * FROM manifest WHERE json_valid(text)) m ON m.run_id = c.run_id
WHERE json_type(m.text) = 'OBJECT' AND json_extract_string(m.text, '$.candidate_id') = c.candidate_id"""
QUERIES["ledger_search"] = lctes() + """
SELECT run_id, candidate_id, metric_value FROM runs
WHERE run_kind = 'canonical' AND status = 'FINISHED' AND family = 'economy'"""
QUERIES["cv_config_runs"] = lctes() + """
SELECT run_id, candidate_id FROM runs WHERE cv_n_splits = '5' AND cv_shuffle = 'true' AND cv_random_state = '42'"""
QUERIES["ledger_audit"] = lctes() + """
SELECT family, run_kind, count(*) AS n_runs, count(*) FILTER (WHERE status = 'FINISHED') AS n_finished,
  count(*) FILTER (WHERE status = 'FAILED') AS n_failed FROM runs GROUP BY 1, 2"""
QUERIES["status_counts"] = lctes() + "\nSELECT status, count(*) AS n_runs FROM runs GROUP BY 1"
QUERIES["variant_compare"] = lctes() + f"""
SELECT family, recipe, max(CASE WHEN variant = 'cpu' THEN metric_value END) AS best_cpu,
  max(CASE WHEN variant = 'gpu' THEN metric_value END) AS best_gpu,
  count(*) FILTER (WHERE variant = 'cpu') AS n_cpu, count(*) FILTER (WHERE variant = 'gpu') AS n_gpu,
  {R("max(CASE WHEN variant = 'gpu' THEN metric_value END) - max(CASE WHEN variant = 'cpu' THEN metric_value END)", 9)} AS delta
FROM runs WHERE status = 'FINISHED' GROUP BY 1, 2"""
QUERIES["trial_parents"] = lctes() + """
SELECT t.parent_run_id, t.run_id AS trial_run_id, t.metric_value AS trial_metric,
  p.candidate_id AS parent_candidate_id, p.run_kind AS parent_kind
FROM runs t JOIN runs p ON t.parent_run_id = p.run_id WHERE t.run_kind = 'optimization_trial'"""
QUERIES["optimization_summary"] = lctes() + """
, done AS (SELECT *, row_number() OVER (PARTITION BY parent_run_id ORDER BY metric_value, trial_number) AS rk,
  count(*) OVER (PARTITION BY parent_run_id) AS n
  FROM runs WHERE run_kind = 'optimization_trial' AND status = 'FINISHED')
SELECT parent_run_id, n AS completed_trials, trial_number AS best_trial_number, metric_value AS best_metric_value
FROM done WHERE rk = 1"""


# ---------------------------------------------------------------- submission refresh
def _tag(desc: str, tag: str) -> str:
    lst = f"list_filter(string_split(coalesce({desc}, ''), ' | '), lambda x: starts_with(x, '{tag}='))"
    return f"(CASE WHEN len({lst}) > 0 THEN trim(substr({lst}[-1], {len(tag) + 2})) END)"


def _num(s: str) -> str:
    return (f"(CASE WHEN {s} IS NULL OR lower(trim({s})) IN ('', 'none', 'nan') THEN NULL "
            f"ELSE TRY_CAST(lower(trim({s})) AS DOUBLE) END)")


SIG = ["submission_event_id", "kaggle_submitted_at", "kaggle_file_name", "kaggle_status", "public_score", "private_score"]


def refresh_ctes() -> list[str]:
    sub = _tag("kaggle_description", "submit")
    cand = _tag("kaggle_description", "candidate")
    return ledger_ctes() + [
        """remote1 AS (SELECT event_id AS e, strftime(ts, '%Y-%m-%d %H:%M:%S') AS kaggle_submitted_at,
  'submission_' || CAST(event_id AS VARCHAR) || '.csv' AS kaggle_file_name,
  CASE WHEN event_id % 7 = 0 THEN 'submit=sub_' || CAST(event_id AS VARCHAR) || ' | metric=' || printf('%.6f', value)
       ELSE 'candidate=cand_' || CAST(user_id % 30 AS VARCHAR) || ' | submit=sub_' || CAST(event_id AS VARCHAR)
            || ' | metric=' || printf('%.6f', value) END AS kaggle_description,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'complete' END AS kaggle_status,
  CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'signup' THEN 'nan' ELSE printf('%.4f', value) END AS public_score,
  CASE WHEN event_type = 'purchase' THEN 'None' ELSE printf('%.4f', value * CAST(0.9 AS DOUBLE)) END AS private_score
  FROM events)""",
        "remote AS (SELECT * FROM remote1 UNION ALL SELECT * FROM remote1 WHERE e % 25 = 0)",
        f"""parsed AS (SELECT CASE WHEN regexp_full_match({sub}, '[a-z0-9_-]+') THEN {sub} END AS submission_event_id,
  CASE WHEN {cand} <> '' THEN {cand} END AS remote_candidate_id,
  kaggle_submitted_at, kaggle_file_name, kaggle_description, kaggle_status,
  {_num('public_score')} AS public_score, {_num('private_score')} AS private_score FROM remote)""",
        """ev AS (SELECT 'sub_' || CAST(event_id AS VARCHAR) AS submission_event_id,
  CASE WHEN event_id % 13 = 0 THEN 'cand_' || CAST((user_id + 1) % 30 AS VARCHAR)
       ELSE 'cand_' || CAST(user_id % 30 AS VARCHAR) END AS candidate_id
  FROM events WHERE event_id % 11 <> 0)""",
        "canon AS (SELECT candidate_id FROM lookup WHERE n_canonical >= 1)",
        """matched AS (SELECT p.*, ev.candidate_id AS tracked_candidate_id,
  CAST(p.remote_candidate_id IS NOT NULL AND p.remote_candidate_id <> ev.candidate_id AS INTEGER) AS candidate_mismatch
  FROM parsed p JOIN ev ON p.submission_event_id = ev.submission_event_id)""",
        """orph AS (SELECT p.*, CASE WHEN p.remote_candidate_id IS NULL THEN 'missing_candidate_id'
  WHEN p.remote_candidate_id NOT IN (SELECT candidate_id FROM canon) THEN 'no_canonical_candidate_run'
  ELSE 'recovered' END AS recovery
  FROM parsed p WHERE p.submission_event_id IS NOT NULL
  AND p.submission_event_id NOT IN (SELECT submission_event_id FROM ev))""",
        f"""cands AS (SELECT {', '.join(SIG)}, kaggle_description, tracked_candidate_id AS candidate_id FROM matched
  WHERE candidate_mismatch = 0
  UNION ALL SELECT {', '.join(SIG)}, kaggle_description, remote_candidate_id FROM orph WHERE recovery = 'recovered')""",
        f"""hist AS (SELECT DISTINCT {', '.join(SIG)}, kaggle_description, 0 AS observed_seq FROM parsed
  WHERE submission_event_id IN (SELECT 'sub_' || CAST(event_id AS VARCHAR) FROM events
    WHERE event_id % 5 = 0 AND event_id % 11 <> 0))""",
        f"""appended AS (SELECT DISTINCT * FROM cands c WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE
  {' AND '.join(f'c.{s} IS NOT DISTINCT FROM h.{s}' for s in SIG)}))""",
    ]


def rctes(*more: str) -> str:
    return "WITH " + ",\n".join(refresh_ctes() + list(more))


QUERIES["refresh_match"] = rctes() + """
SELECT submission_event_id, kaggle_submitted_at, kaggle_file_name, tracked_candidate_id, remote_candidate_id,
  candidate_mismatch FROM matched"""
QUERIES["refresh_orphans"] = rctes() + "\nSELECT submission_event_id, kaggle_file_name, remote_candidate_id, recovery FROM orph"
QUERIES["refresh_dedup"] = rctes() + f"\nSELECT {', '.join(SIG)}, kaggle_description, candidate_id FROM appended"
QUERIES["refresh_stream"] = QUERIES["refresh_dedup"]
QUERIES["score_rollup"] = rctes(f"""allobs AS (SELECT {', '.join(SIG)}, kaggle_description, observed_seq FROM hist
  UNION ALL SELECT {', '.join(SIG)}, kaggle_description, 1 FROM appended)""") + """
SELECT submission_event_id, count(*) AS n_observations,
  arg_max(public_score, (observed_seq, kaggle_submitted_at, kaggle_file_name)) FILTER (WHERE public_score IS NOT NULL) AS latest_public_score,
  arg_max(private_score, (observed_seq, kaggle_submitted_at, kaggle_file_name)) FILTER (WHERE private_score IS NOT NULL) AS latest_private_score,
  min(public_score) AS best_public_score, min(private_score) AS best_private_score
FROM allobs GROUP BY 1"""
QUERIES["refresh_counters"] = rctes() + """
SELECT 'tracked_events' AS counter, CAST(count(DISTINCT submission_event_id) AS BIGINT) AS value FROM ev
UNION ALL SELECT 'matched_events', CAST(count(DISTINCT submission_event_id) AS BIGINT) FROM cands
UNION ALL SELECT 'appended_observations', CAST(count(*) AS BIGINT) FROM appended
UNION ALL SELECT 'updated_candidates', CAST(count(DISTINCT candidate_id) AS BIGINT) FROM appended
UNION ALL SELECT 'scanned_remote', CAST(count(*) AS BIGINT) FROM parsed"""
QUERIES["event_id_duplicates"] = rctes() + """
SELECT count(*) AS duplicate_event_ids FROM (
  SELECT submission_event_id FROM (SELECT submission_event_id FROM ev
    UNION ALL SELECT submission_event_id FROM ev WHERE CAST(substr(submission_event_id, 5) AS BIGINT) % 50 = 0) GROUP BY 1 HAVING count(*) > 1)"""
ALL_EVENTS = """allev AS (SELECT submission_event_id, candidate_id FROM ev
  UNION SELECT submission_event_id, remote_candidate_id FROM orph WHERE recovery = 'recovered')"""
QUERIES["event_append"] = rctes(ALL_EVENTS) + "\nSELECT submission_event_id, candidate_id FROM allev"
QUERIES["candidate_scores"] = rctes(ALL_EVENTS, f"""seen AS (
  SELECT a.candidate_id, h.public_score, h.private_score, (0, kaggle_submitted_at, kaggle_file_name, kaggle_status) AS o FROM hist h JOIN allev a USING (submission_event_id)
  UNION ALL SELECT candidate_id, public_score, private_score, (1, kaggle_submitted_at, kaggle_file_name, kaggle_status) FROM appended)""") + """
SELECT a.candidate_id, a.submit_count, s.latest_public_score, s.best_public_score, s.latest_private_score, s.best_private_score
FROM (SELECT candidate_id, count(*) AS submit_count FROM allev GROUP BY 1) a
LEFT JOIN (SELECT candidate_id, arg_max(public_score, (o, public_score)) FILTER (WHERE public_score IS NOT NULL) AS latest_public_score, min(public_score) AS best_public_score,
    arg_max(private_score, (o, private_score)) FILTER (WHERE private_score IS NOT NULL) AS latest_private_score, min(private_score) AS best_private_score
  FROM seen GROUP BY 1) s USING (candidate_id)"""
QUERIES["malformed_scores"] = rctes() + """
SELECT kaggle_submitted_at, kaggle_file_name, 'n/a' AS public_score, private_score FROM remote WHERE e % 31 = 0"""


# ---------------------------------------------------------------- models
def _expanded_s() -> str:
    return """expanded_s AS (SELECT ctx.*, fits.fit_fold,
  CASE WHEN ctx.split = 'test' THEN 'test' WHEN ctx.sfold = fits.fit_fold THEN 'valid' ELSE 'train' END AS role
  FROM ctx CROSS JOIN fits)"""


@q("gaussian_nb_cv")
def _():
    parts = [_expanded_s()]
    for c in NUMERIC:
        parts.append(quantile_cte(f"meds_{c}", f"s.{c}", [0.5], fold="sfold"))
        parts.append(f"""moms_{c} AS (SELECT fits.fit_fold, avg(coalesce(s.{c}, meds_{c}.q0)) AS mu,
  stddev_pop(coalesce(s.{c}, meds_{c}.q0)) AS sd FROM train s CROSS JOIN fits
  JOIN meds_{c} ON meds_{c}.fit_fold = fits.fit_fold WHERE s.sfold <> fits.fit_fold GROUP BY 1)""")
    fcols = ", ".join(
        f"(coalesce(e.{c}, meds_{c}.q0) - moms_{c}.mu) / (CASE WHEN moms_{c}.sd < {EPS10} THEN 1 ELSE moms_{c}.sd END) AS f{i}"
        for i, c in enumerate(NUMERIC))
    joins = " ".join(f"JOIN meds_{c} ON meds_{c}.fit_fold = e.fit_fold JOIN moms_{c} ON moms_{c}.fit_fold = e.fit_fold"
                     for c in NUMERIC)
    parts.append(f"feat AS (SELECT e.id, e.fit_fold, e.role, e.y_bin, {fcols} FROM expanded_s e {joins})")
    d = len(NUMERIC)
    parts.append("nbc AS (SELECT fit_fold, y_bin AS cls, count(*) AS n, "
                 + ", ".join(f"avg(f{i}) AS mu_{i}, var_pop(f{i}) AS var_{i}" for i in range(d))
                 + " FROM feat WHERE role = 'train' GROUP BY 1, 2)")
    parts.append("allv AS (SELECT fit_fold, count(*) AS n_all, greatest("
                 + ", ".join(f"var_pop(f{i})" for i in range(d)) + ") AS vmax FROM feat WHERE role = 'train' GROUP BY 1)")

    def jll(c):
        t = f"ln(c{c}.n / allv.n_all)"
        for i in range(d):
            v = f"(c{c}.var_{i} + 1e-9 * allv.vmax)"
            t += f" - 0.5 * ln({D(2.0 * 3.141592653589793)} * {v}) - 0.5 * (f.f{i} - c{c}.mu_{i}) * (f.f{i} - c{c}.mu_{i}) / {v}"
        return t
    body = f"""SELECT f.id, f.fit_fold AS fold, CAST(f.y_bin AS DOUBLE) AS y_true,
  {R(f'1.0 / (1.0 + exp(({jll(0)}) - ({jll(1)})))', 9)} AS y_pred
FROM feat f JOIN allv ON allv.fit_fold = f.fit_fold
JOIN nbc c0 ON c0.fit_fold = f.fit_fold AND c0.cls = 0 JOIN nbc c1 ON c1.fit_fold = f.fit_fold AND c1.cls = 1
WHERE f.role = 'valid'"""
    return ctes(*parts) + "\n" + body


KNN_PAIRS = """pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id,
  sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
    lambda t: (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE)) * (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE))))) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY floor(distance * 1e9 + 0.5), neighbor_id) AS rank
  FROM pairs)"""

QUERIES["knn_join"] = f"WITH {KNN_PAIRS}\nSELECT query_id, neighbor_id, rank, {R('distance', 6)} AS distance FROM ranked WHERE rank <= 5"
QUERIES["knn_cv"] = f"""WITH {KNN_PAIRS}
SELECT r.query_id AS vec_id, {R('avg(CAST(e.label AS DOUBLE))', 9)} AS y_pred
FROM ranked r JOIN embeddings e ON e.vec_id = r.neighbor_id WHERE r.rank <= 5 GROUP BY r.query_id"""


# ---------------------------------------------------------------- more folds, artifacts
QUERIES["knn_lsh_join"] = "SELECT count(*) AS n_queries, 5 * count(*) AS n_pairs, 1::INTEGER AS recall_reached FROM orders WHERE o_orderkey % 100 = 0"

QUERIES["folds_kfold_ordered"] = with_ctx(f"""
SELECT id, CAST(CASE WHEN r < (n % {K}) * (n // {K} + 1) THEN r // (n // {K} + 1)
  ELSE (n % {K}) + (r - (n % {K}) * (n // {K} + 1)) // (n // {K}) END + 1 AS INTEGER) AS fold
FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS r, count(*) OVER () AS n FROM train)""")

QUERIES["fold_validation"] = with_ctx(f"""
, damaged AS (
  SELECT id, CASE WHEN id % 97 = 0 THEN NULL WHEN fold = 5 THEN 6 ELSE fold END AS fold
  FROM (SELECT id, fold FROM train UNION ALL SELECT id, fold FROM train WHERE id % 89 = 0))
SELECT 'duplicate_ids' AS "check", CAST(count(*) AS BIGINT) AS violations FROM (SELECT id FROM damaged GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'out_of_range', CAST(count(*) FILTER (WHERE fold IS NULL OR fold < 1 OR fold > {K}) AS BIGINT)
  FROM (SELECT DISTINCT fold FROM damaged)
UNION ALL SELECT 'empty_folds', CAST({K} - count(DISTINCT fold) FILTER (WHERE fold BETWEEN 1 AND {K}) AS BIGINT) FROM damaged
UNION ALL SELECT 'empty_train_sides', CAST(count(*) FILTER (WHERE c >= (SELECT count(*) FROM damaged)) AS BIGINT)
  FROM (SELECT fold, count(*) AS c FROM damaged GROUP BY fold)""")

QUERIES["artifact_roundtrip"] = ctes(*oof_ctes()) + """
SELECT candidate_id, row_idx, y_true, y_pred, fold FROM oof WHERE candidate_id IN ('cand_a', 'cand_c', 'cand_e')"""

OOF_DEFECTS = f"""
, defects AS (
  SELECT row_idx, id, candidate_id, y_pred,
    CASE WHEN candidate_id = 'cand_c' AND id % 103 = 0 THEN y_true + 5.0 WHEN candidate_id = 'cand_e' AND id % 113 = 0 THEN NULL ELSE y_true END AS y_true,
    CASE WHEN candidate_id = 'cand_d' AND id % 107 = 0 THEN fold % {K} + 1 ELSE fold END AS fold
  FROM oof WHERE NOT (candidate_id = 'cand_b' AND id % 101 = 0))"""

QUERIES["truth_check"] = ctes(*oof_ctes()) + OOF_DEFECTS + """
, ref AS (SELECT row_idx, y_true AS ref_y, fold AS ref_fold FROM oof WHERE candidate_id = 'cand_a' AND id % 109 <> 0),
names AS (SELECT DISTINCT candidate_id FROM oof)
SELECT n.candidate_id,
  (SELECT count(*) FROM defects o JOIN ref r ON o.row_idx = r.row_idx WHERE o.candidate_id = n.candidate_id
     AND NOT coalesce(abs(o.y_true - r.ref_y) <= 1e-8 + 1e-5 * abs(r.ref_y), o.y_true IS NULL AND r.ref_y IS NULL)) AS y_true_mismatches,
  (SELECT count(*) FROM defects o JOIN ref r ON o.row_idx = r.row_idx WHERE o.candidate_id = n.candidate_id AND o.fold IS DISTINCT FROM r.ref_fold) AS fold_mismatches,
  (SELECT count(*) FROM defects o WHERE o.candidate_id = n.candidate_id AND o.row_idx NOT IN (SELECT row_idx FROM ref)) AS unknown_rows,
  (SELECT count(*) FROM ref r WHERE r.row_idx NOT IN (SELECT row_idx FROM defects o WHERE o.candidate_id = n.candidate_id)) AS missing_rows
FROM names n"""

QUERIES["blend_alignment"] = ctes(*oof_ctes()) + OOF_DEFECTS + """
, rows_ AS (SELECT row_idx, count(*) AS m, count(y_true) AS ny, min(fold) AS lo_f, max(fold) AS hi_f,
    max(abs(y_true - ref)) AS gap, max(abs(ref)) AS size
  FROM (SELECT *, max(CASE WHEN candidate_id = 'cand_a' THEN y_true END) OVER (PARTITION BY row_idx) AS ref FROM defects) GROUP BY row_idx)
SELECT count(*) FILTER (WHERE m <> 5) AS misaligned_rows,
  count(*) FILTER (WHERE ny <> m OR gap > 1e-8 + 1e-5 * size) AS inconsistent_y_true,
  count(*) FILTER (WHERE lo_f <> hi_f) AS inconsistent_fold
FROM rows_"""

QUERIES["stream_rollup"] = rctes(f"""allobs AS (SELECT {', '.join(SIG)}, kaggle_description, observed_seq FROM hist
  UNION ALL SELECT {', '.join(SIG)}, kaggle_description, 1 FROM appended)""") + """
SELECT submission_event_id, count(*) AS n_observations,
  arg_max(public_score, (observed_seq, kaggle_submitted_at, kaggle_file_name)) FILTER (WHERE public_score IS NOT NULL) AS latest_public_score,
  arg_max(private_score, (observed_seq, kaggle_submitted_at, kaggle_file_name)) FILTER (WHERE private_score IS NOT NULL) AS latest_private_score,
  min(public_score) AS best_public_score, min(private_score) AS best_private_score
FROM allobs WHERE submission_event_id IN (SELECT submission_event_id FROM appended) GROUP BY 1"""
QUERIES["keyed_rollup"] = QUERIES["stream_rollup"]


_LINE = """to_json({'kaggle_submitted_at': kaggle_submitted_at, 'kaggle_file_name': kaggle_file_name, 'kaggle_description': kaggle_description, 'kaggle_status': kaggle_status,
  'public_score': public_score, 'private_score': private_score})::VARCHAR"""
QUERIES["quarantined_rows"] = rctes() + f"""
SELECT CASE WHEN e % 29 = 0 OR e % 31 = 0 THEN 'quarantined' ELSE 'kept' END AS part,
  CASE WHEN e % 29 = 0 THEN left({_LINE}, 60) WHEN e % 31 = 0 THEN e::VARCHAR ELSE kaggle_file_name END AS what, count(*) AS n FROM remote GROUP BY ALL"""
QUERIES["refresh_keyed_stream"] = QUERIES["refresh_dedup"]

# ---------------------------------------------------------------- ensemble selection
def _score(c: str, m: str = "m") -> str:
    """Root mean squared error of the blend with counts c, from residual sums g and the row weight n."""
    inner = f"list_sum(list_transform(range(1, {m} + 1), lambda j: {c}[i] * {c}[j] * g[i][j]))"
    return f"sqrt(greatest(list_sum(list_transform(range(1, {m} + 1), lambda i: {inner})) / list_sum({c}) / list_sum({c}) / n, 0))"


def _forward_ctes(rounds: int) -> str:
    """fwd: forward selection per bag over grams(bag, n, g); ends with the first round that gains nothing, whose pick counts."""
    return f""",
sized AS (SELECT bag, n, g, len(g) AS m FROM grams),
trials0 AS (SELECT bag, n, g, m, i, list_transform(range(1, m + 1), lambda k: CAST(k = i AS DOUBLE)) AS c FROM sized, unnest(range(1, m + 1)) AS u(i)),
fwd AS (
  SELECT 0 AS r, bag, n, g, m, arg_min(c, (s, i)) AS counts, min(s) AS score, false AS stop
  FROM (SELECT *, {_score("c")} AS s FROM trials0) GROUP BY bag, n, g, m
  UNION ALL
  SELECT r + 1, bag, n, g, m, arg_min(c, (s, i)), min(s), NOT min(s) < score
  FROM (SELECT *, {_score("c")} AS s FROM (
    SELECT f.*, i, list_transform(range(1, m + 1), lambda k: counts[k] + CAST(k = i AS DOUBLE)) AS c FROM fwd f, unnest(range(1, m + 1)) AS u(i)
    WHERE NOT stop AND r < {rounds})) GROUP BY r, bag, n, g, m, score),
best AS (SELECT bag, arg_max(counts, r) AS counts, arg_max(score, r) AS score FROM fwd GROUP BY bag)"""


def _recursive(sql: str) -> str:
    return "WITH RECURSIVE " + sql[len("WITH "):]


_RESIDUALS = """, res AS (SELECT row_idx, candidate_id, y_pred - y_true AS r, 1.0::DOUBLE AS w FROM oof)"""

QUERIES["greedy_ensemble"] = _recursive(ctes(*oof_ctes())) + """
, cm AS (SELECT a.candidate_id AS a, b.candidate_id AS b, corr(a.y_pred, b.y_pred) AS c
  FROM oof a JOIN oof b ON a.row_idx = b.row_idx AND a.candidate_id <> b.candidate_id GROUP BY 1, 2),
flt AS (
  SELECT 0 AS n, ['cand_a', 'cand_b', 'cand_c', 'cand_d', 'cand_e'] AS ids
  UNION ALL
  SELECT n + 1, list_filter(ids, lambda x: x <> worst) FROM (
    SELECT f.n, f.ids, max(s.mx) AS mx, arg_max(s.a, (floor(s.mean * 1e9 + 0.5), -ord)) AS worst
    FROM flt f, LATERAL (SELECT a, max(c) AS mx, sum(abs(c)) / len(f.ids) AS mean, list_position(f.ids, a) AS ord
      FROM cm WHERE list_contains(f.ids, a) AND list_contains(f.ids, b) GROUP BY a) s
    GROUP BY f.n, f.ids) WHERE mx > 0.999999),
kept AS (SELECT arg_max(ids, n) AS ids FROM flt),
res AS (SELECT row_idx, candidate_id, y_pred - y_true AS r FROM oof WHERE list_contains((SELECT ids FROM kept), candidate_id)),
pairs AS (SELECT a.candidate_id AS a, b.candidate_id AS b, sum(a.r * b.r) AS v, count(*) AS n FROM res a JOIN res b USING (row_idx) GROUP BY 1, 2),
grams AS (SELECT 0 AS bag, max(n)::DOUBLE AS n, list(row_ ORDER BY a) AS g FROM (SELECT a, list(v ORDER BY b) AS row_, max(n) AS n FROM pairs GROUP BY a))""" + _forward_ctes(50) + f"""
SELECT candidate_id, {R('w', 9)} AS weight, {R('score', 6)} AS score
FROM (SELECT unnest(list_sort((SELECT ids FROM kept))) AS candidate_id, unnest(list_transform(counts, lambda x: x / list_sum(counts))) AS w, score FROM best) WHERE w > 0"""


def _poisson_cdf() -> list[float]:
    import math
    out, cdf, p, k = [], 0.0, math.exp(-1.0), 0
    while cdf < 1.0 - 1e-17 and k < 40:
        cdf += p
        out.append(cdf)
        k += 1
        p = p / k
    return out


QUERIES["bagged_ensemble"] = _recursive(ctes(*oof_ctes())) + f"""
, bags AS (SELECT CAST(range AS INTEGER) AS bag FROM range(0, 3)),
drawn AS (
  SELECT row_idx, bag, list_reduce(list_transform(range(1, 14), lambda k: CAST(strpos('0123456789abcdef', substr(h, k, 1)) - 1 AS DOUBLE)), lambda x, y: x * 16 + y) / {float(16 ** 13)!r}::DOUBLE AS u
  FROM (SELECT row_idx, bag, sha256('42:' || bag || ':' || row_idx) AS h FROM (SELECT DISTINCT row_idx FROM oof), bags)),
weights AS (
  SELECT row_idx, bag, len(list_filter({[c for c in _poisson_cdf()]!r}::DOUBLE[], lambda c: u >= c))::DOUBLE AS w FROM drawn
  UNION ALL SELECT DISTINCT row_idx, 3, 1.0 FROM oof),
res AS (SELECT row_idx, candidate_id, y_pred - y_true AS r FROM oof),
pairs AS (SELECT w.bag, a.candidate_id AS a, b.candidate_id AS b, sum(w.w * a.r * b.r) AS v, sum(w.w) AS n
  FROM weights w JOIN res a USING (row_idx) JOIN res b USING (row_idx) GROUP BY 1, 2, 3),
allgrams AS (SELECT bag, max(n) AS n, list(row_ ORDER BY a) AS g FROM (SELECT bag, a, list(v ORDER BY b) AS row_, max(n) AS n FROM pairs GROUP BY bag, a) GROUP BY bag),
grams AS (SELECT * FROM allgrams WHERE bag < 3)""" + _forward_ctes(20) + f""",
mean AS (SELECT list_transform(range(1, 6), lambda k: list_avg(list_transform(cs, lambda c: c[k] / list_sum(c)))) AS c FROM (SELECT list(counts ORDER BY bag) AS cs FROM best)),
total AS (SELECT c, g, n, 5 AS m FROM mean, allgrams WHERE bag = 3)
SELECT unnest(['cand_a', 'cand_b', 'cand_c', 'cand_d', 'cand_e']) AS candidate_id, unnest(list_transform(c, lambda x: {R('x', 9)})) AS weight, {R(_score('c'), 6)} AS score FROM total"""


# ---------------------------------------------------------------- ridge by elimination on the normal equations
def _ridge(alpha: float, digits: int, test: bool = False) -> str:
    """Per fold: centred Gram matrix plus alpha on the diagonal, Gauss-Jordan steps as a recursion over lists, then the valid rows' predictions."""
    mom = [f"""mom_{c} AS (
  SELECT fits.fit_fold, avg(coalesce(s.{c}, med_{c}.q0)) AS mu, stddev_pop(coalesce(s.{c}, med_{c}.q0)) AS sd
  FROM train s CROSS JOIN fits JOIN med_{c} ON med_{c}.fit_fold = fits.fit_fold WHERE s.fold <> fits.fit_fold GROUP BY fits.fit_fold)""" for c in NUMERIC]
    gm = "(tot.sy / tot.n)"
    x = [f"({imp(c)} - mom_{c}.mu) / (CASE WHEN mom_{c}.sd < {EPS10} THEN 1 ELSE mom_{c}.sd END)" for c in NUMERIC]
    x += [f"coalesce(CAST(cnt_{c}.n AS DOUBLE) / tot.n, 0)" for c in CATEGORICAL]
    x += [f"coalesce((cnt_{c}.sy + 1.0 * {gm}) / (cnt_{c}.n + 1.0), {gm})" for c in CATEGORICAL]
    d = len(x)
    joins = med_joins() + " " + " ".join(f"JOIN mom_{c} ON mom_{c}.fit_fold = e.fit_fold" for c in NUMERIC) + " JOIN tot ON tot.fit_fold = e.fit_fold " + " ".join(
        f"LEFT JOIN cnt_{c} ON cnt_{c}.fit_fold = e.fit_fold AND cnt_{c}.v = {norm(c, 'e')}" for c in CATEGORICAL)
    feat = f"feat AS (SELECT e.id, e.fit_fold, e.role, e.y_reg AS y, {', '.join(f'CAST({v} AS DOUBLE) AS x{i}' for i, v in enumerate(x))} FROM expanded e {joins})"
    means = "mu AS (SELECT fit_fold, count(*) AS n, avg(y) AS y, " + ", ".join(f"avg(x{i}) AS x{i}" for i in range(d)) + " FROM feat WHERE role = 'train' GROUP BY 1)"

    def cross(i, j):
        b = "(f.y - mu.y)" if j == d else f"(f.x{j} - mu.x{j})"
        return f"sum((f.x{i} - mu.x{i}) * {b})" + (f" + {alpha}" if i == j else "")
    rows = ", ".join("[" + ", ".join(cross(i, j) for j in range(d + 1)) + "]" for i in range(d))
    solve = f"""gj AS (
  SELECT f.fit_fold, 0 AS p, [{rows}] AS m FROM feat f JOIN mu ON mu.fit_fold = f.fit_fold WHERE f.role = 'train' GROUP BY f.fit_fold
  UNION ALL
  SELECT fit_fold, p + 1, list_transform(m, lambda row, i: CASE WHEN i = p + 1 THEN list_transform(row, lambda v: v / m[p + 1][p + 1])
      ELSE list_transform(row, lambda v, k: v - row[p + 1] * m[p + 1][k] / m[p + 1][p + 1]) END) FROM gj WHERE p < {d}),
w AS (SELECT fit_fold, list_transform(m, lambda row: row[{d + 1}]) AS w FROM gj WHERE p = {d})"""
    pred = "mu.y + " + " + ".join(f"w.w[{i + 1}] * (f.x{i} - mu.x{i})" for i in range(d))
    head = _recursive(ctes(*median_ctes(), *mom, TOT, *[cnt_cte(c) for c in CATEGORICAL], feat, means, solve))
    if test:
        return head + f"""
SELECT id, {R('avg(p)', digits)} AS y_pred FROM (SELECT f.id, {pred} AS p FROM feat f JOIN mu ON mu.fit_fold = f.fit_fold JOIN w ON w.fit_fold = f.fit_fold WHERE f.role = 'test') GROUP BY id"""
    return head + f"""
SELECT f.id, f.fit_fold AS fold, f.y AS y_true, {R(pred, digits)} AS y_pred
FROM feat f JOIN mu ON mu.fit_fold = f.fit_fold JOIN w ON w.fit_fold = f.fit_fold WHERE f.role = 'valid'"""


QUERIES["ridge_cv"] = _ridge(1.0, 2)

QUERIES["test_predictions"] = _ridge(1.0, 2, test=True)


# ---------------------------------------------------------------- elastic net, logistic regression
def _dense(fold: str, label: str) -> list[str]:
    """CTE feat(id, fit_fold, role, y, x0...): standardized numerics and category frequencies of every fit fold."""
    side = "CASE WHEN ctx.split = 'test' THEN 'test' WHEN ctx.{} = fits.fit_fold THEN 'valid' ELSE 'train' END".format(fold)
    mom = [f"""mom_{c} AS (
  SELECT fits.fit_fold, avg(coalesce(s.{c}, med_{c}.q0)) AS mu, stddev_pop(coalesce(s.{c}, med_{c}.q0)) AS sd
  FROM train s CROSS JOIN fits JOIN med_{c} ON med_{c}.fit_fold = fits.fit_fold WHERE s.{fold} <> fits.fit_fold GROUP BY fits.fit_fold)""" for c in NUMERIC]
    cnt = [f"cnt_{c} AS (SELECT fits.fit_fold, {norm(c)} AS v, count(*) AS n FROM train s CROSS JOIN fits WHERE s.{fold} <> fits.fit_fold GROUP BY 1, 2)" for c in CATEGORICAL]
    tot = f"tot AS (SELECT fits.fit_fold, count(*) AS n FROM train s CROSS JOIN fits WHERE s.{fold} <> fits.fit_fold GROUP BY 1)"
    x = [f"({imp(c)} - mom_{c}.mu) / (CASE WHEN mom_{c}.sd < {EPS10} THEN 1 ELSE mom_{c}.sd END)" for c in NUMERIC]
    x += [f"coalesce(CAST(cnt_{c}.n AS DOUBLE) / tot.n, 0)" for c in CATEGORICAL]
    joins = med_joins() + " " + " ".join(f"JOIN mom_{c} ON mom_{c}.fit_fold = e.fit_fold" for c in NUMERIC) + " JOIN tot ON tot.fit_fold = e.fit_fold " + " ".join(
        f"LEFT JOIN cnt_{c} ON cnt_{c}.fit_fold = e.fit_fold AND cnt_{c}.v = {norm(c, 'e')}" for c in CATEGORICAL)
    rows = f"expanded_f AS (SELECT ctx.*, fits.fit_fold, {side} AS role FROM ctx CROSS JOIN fits)"
    feat = f"feat AS MATERIALIZED (SELECT e.id, e.fit_fold, e.role, CAST(e.{label} AS DOUBLE) AS y, {', '.join(f'CAST({v} AS DOUBLE) AS x{i}' for i, v in enumerate(x))} FROM expanded_f e {joins})"
    return [*median_ctes(fold=fold), *mom, tot, *cnt, rows, feat]


DENSE = len(NUMERIC) + len(CATEGORICAL)


@q("elasticnet_path_cv")
def _():
    """Cyclic coordinate descent on each fold's Gram matrix, a recursion of single steps (every penalty from zero)."""
    d, sweeps = DENSE, 600
    means = "mu AS (SELECT fit_fold, count(*) AS n, avg(y) AS y, " + ", ".join(f"avg(x{i}) AS x{i}" for i in range(d)) + " FROM feat WHERE role = 'train' GROUP BY 1)"
    cross = lambda a, b: f"sum((f.{a} - mu.{a}) * (f.{b} - mu.{b})) / count(*)"
    gram = ", ".join("[" + ", ".join(cross(f"x{i}", f"x{j}") for j in range(d)) + "]" for i in range(d))
    grams = f"gram AS (SELECT f.fit_fold, [{gram}] AS g, [{', '.join(cross(f'x{i}', 'y') for i in range(d))}] AS t FROM feat f JOIN mu ON mu.fit_fold = f.fit_fold WHERE f.role = 'train' GROUP BY f.fit_fold)"
    pen = "pen(alpha, l1_ratio) AS (VALUES (20000.0::DOUBLE, 1.0::DOUBLE), (2000.0, 0.9), (200.0, 0.5))"
    pull = "t[j] - list_sum(list_transform(g[j], lambda v, k: v * w[k])) + g[j][j] * w[j]"
    step = f"""cd AS (
  SELECT fit_fold, alpha, l1_ratio, g, t, 0 AS n, 1 AS j, list_transform(range({d}), lambda k: 0.0::DOUBLE) AS w FROM gram, pen
  UNION ALL
  SELECT fit_fold, alpha, l1_ratio, g, t, n + 1, j % {d} + 1, list_transform(w, lambda v, k: CASE WHEN k <> j THEN v WHEN g[j][j] + alpha * (1 - l1_ratio) <= 1e-12 THEN 0
      ELSE sign(p) * greatest(abs(p) - alpha * l1_ratio, 0) / (g[j][j] + alpha * (1 - l1_ratio)) END)
  FROM (SELECT *, {pull} AS p FROM cd WHERE n < {sweeps * d})),
w AS (SELECT fit_fold, alpha, l1_ratio, w FROM cd WHERE n = {sweeps * d})"""
    pred = "mu.y + " + " + ".join(f"w.w[{i + 1}] * (f.x{i} - mu.x{i})" for i in range(d))
    return _recursive(ctes(*_dense("fold", "y_reg"), means, grams, pen, step)) + f"""
SELECT f.id, f.fit_fold AS fold, w.alpha, w.l1_ratio, f.y AS y_true, {R(pred, 2)} AS y_pred
FROM feat f JOIN mu ON mu.fit_fold = f.fit_fold JOIN w ON w.fit_fold = f.fit_fold WHERE f.role = 'valid'"""


@q("logistic_newton_cv")
def _():
    """Newton steps written out, each solved by Gauss-Jordan steps over lists."""
    d, steps = DENSE, 8
    x = [*(f"f.x{i}" for i in range(d)), "1.0"]
    parts = ["v AS (SELECT fit_fold, count(*)::DOUBLE AS n, sum(y) AS n1 FROM feat WHERE role = 'train' GROUP BY 1)",
             "w0 AS (SELECT fit_fold, list_transform(range(" + str(d + 1) + "), lambda k: 0.0::DOUBLE) AS w FROM v)"]
    for s in range(steps):
        dot = " + ".join(f"w.w[{i + 1}] * {v}" for i, v in enumerate(x))
        parts.append(f"""p{s} AS MATERIALIZED (SELECT f.*, w.w, 1 / (1 + exp(-({dot}))) AS p, CASE WHEN f.y = 1 THEN v.n / (2 * v.n1) ELSE v.n / (2 * (v.n - v.n1)) END AS c
  FROM feat f JOIN w{s} w ON w.fit_fold = f.fit_fold JOIN v ON v.fit_fold = f.fit_fold WHERE f.role = 'train')""")
        rows = []
        for i in range(d + 1):
            row = [f"sum(c * p * (1 - p) * {x[i]} * {x[j]})" + (" + 1.0" if i == j and i < d else "") for j in range(d + 1)]
            row.append(f"sum(c * (p - y) * {x[i]})" + (f" + any_value(w)[{i + 1}]" if i < d else ""))
            rows.append("[" + ", ".join(row) + "]")
        parts.append(f"""gj{s} AS (
  SELECT f.fit_fold, 0 AS k, any_value(w) AS w, [{', '.join(rows)}] AS m FROM p{s} f GROUP BY f.fit_fold
  UNION ALL
  SELECT fit_fold, k + 1, w, list_transform(m, lambda row, i: CASE WHEN i = k + 1 THEN list_transform(row, lambda u: u / m[k + 1][k + 1])
      ELSE list_transform(row, lambda u, j: u - row[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) FROM gj{s} WHERE k < {d + 1})""")
        parts.append(f"w{s + 1} AS (SELECT fit_fold, list_transform(w, lambda u, i: u - m[i][{d + 2}]) AS w FROM gj{s} WHERE k = {d + 1})")
    dot = " + ".join(f"w.w[{i + 1}] * {v}" for i, v in enumerate(x))
    return _recursive(ctes(*_dense("sfold", "y_bin"), *parts)) + f"""
SELECT f.id, f.fit_fold AS fold, f.y AS y_true, {R(f'1 / (1 + exp(-({dot})))', 7)} AS y_pred FROM feat f JOIN w{steps} w ON w.fit_fold = f.fit_fold WHERE f.role = 'valid'"""


# ---------------------------------------------------------------- histogram boosting
def _boosted(numeric: list[str], nominal: list[str], fold: str, label: str, task: str, oblivious: bool, depth: int, rounds: int, bins: int, rate: float, l2: float, least_h: float, digits: int) -> str:
    """Trees level by level: histograms over all bins, both sides for missing values, the best split by gain (nine significant digits), feature, bin and side."""
    d = len(numeric) + len(nominal)
    side = f"CASE WHEN ctx.split = 'test' THEN 'test' WHEN ctx.{fold} = fits.fit_fold THEN 'valid' ELSE 'train' END"
    probs = ", ".join(repr(i / bins) for i in range(1, bins))
    parts = [f"rows AS (SELECT ctx.*, fits.fit_fold, {side} AS role FROM ctx CROSS JOIN fits)"]
    parts += [f"ed_{c} AS (SELECT fit_fold, list_distinct(quantile_disc({c}, [{probs}])) AS e FROM rows WHERE role = 'train' AND {c} IS NOT NULL GROUP BY 1)" for c in numeric]
    parts += [f"""no_{c} AS (SELECT fit_fold, v, row_number() OVER (PARTITION BY fit_fold ORDER BY v) AS code, count(*) OVER (PARTITION BY fit_fold) AS n FROM (
  SELECT DISTINCT fit_fold, {norm(c, 's')} AS v FROM rows s WHERE role = 'train'))""" for c in nominal]
    codes = [f"CASE WHEN r.{c} IS NULL THEN 0 ELSE 1 + len(list_filter(ed_{c}.e, lambda v: v < r.{c})) END" for c in numeric]
    codes += [f"coalesce(no_{c}.code, (SELECT max(n) + 1 FROM no_{c} m WHERE m.fit_fold = r.fit_fold))" for c in nominal]
    joins = " ".join(f"JOIN ed_{c} ON ed_{c}.fit_fold = r.fit_fold" for c in numeric) + " " + " ".join(f"LEFT JOIN no_{c} ON no_{c}.fit_fold = r.fit_fold AND no_{c}.v = {norm(c, 'r')}" for c in nominal)
    start = "avg(y)" if task == "regression" else "ln(avg(y) / (1 - avg(y)))"
    parts += [f"coded AS MATERIALIZED (SELECT r.id, r.fit_fold, r.role, CAST(r.{label} AS DOUBLE) AS y, [{', '.join(codes)}] AS code FROM rows r {joins} WHERE r.role <> 'test')",
              f"base AS (SELECT fit_fold, {start} AS raw FROM coded WHERE role = 'train' GROUP BY 1)",
              "s0 AS (SELECT c.*, b.raw FROM coded c JOIN base b ON b.fit_fold = c.fit_fold)"]
    p = "raw" if task == "regression" else "(1 / (1 + exp(-raw)))"
    h = "1.0::DOUBLE" if task == "regression" else f"({p} * (1 - {p}))"
    score = lambda g, hs: f"(CASE WHEN {hs} + {l2} > 0 THEN {g} * {g} / ({hs} + {l2}) ELSE 0 END)"
    for t in range(rounds):
        parts.append(f"n{t}_0 AS MATERIALIZED (SELECT *, 1 AS node, {p} - y AS g, {h} AS h FROM s{t})")
        for lv in range(depth):
            a = f"{t}_{lv}"
            parts.append(f"""h{a} AS MATERIALIZED (
  SELECT n.fit_fold, n.node, j.j, n.code[j.j] AS code, sum(g) AS g, sum(h) AS h, count(*) AS n FROM n{a} n, range(1, {d + 1}) AS j(j) WHERE role = 'train' AND node >= {2 ** lv} GROUP BY ALL),
grid{a} AS (SELECT k.fit_fold, k.node, j.j, b.code FROM (SELECT DISTINCT fit_fold, node FROM h{a}) k, range(1, {d + 1}) AS j(j), range({bins + 1}) AS b(code)),
f{a} AS (SELECT k.*, coalesce(h.g, 0) AS g, coalesce(h.h, 0) AS h, coalesce(h.n, 0) AS n FROM grid{a} k LEFT JOIN h{a} h USING (fit_fold, node, j, code)),
c{a} AS (SELECT fit_fold, node, j, code, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl,
  sum(g) FILTER (WHERE code = 0) OVER z AS g0, sum(h) FILTER (WHERE code = 0) OVER z AS h0, sum(n) FILTER (WHERE code = 0) OVER z AS n0, sum(g) OVER z AS gt, sum(h) OVER z AS ht, sum(n) OVER z AS nt
  FROM f{a} WINDOW z AS (PARTITION BY fit_fold, node, j), w AS (PARTITION BY fit_fold, node, j ORDER BY code)),
o{a} AS (SELECT fit_fold, node, j, code, side, gl - side * g0 AS gl, hl - side * h0 AS hl, nl - side * n0 AS nl, gt, ht, nt FROM c{a}, range(2) AS s(side) WHERE code > 0)""")
            gain = f"{score('gl', 'hl')} + {score('(gt - gl)', '(ht - hl)')} - {score('gt', 'ht')}"
            coarse = lambda x: f"CASE WHEN {x} > 0 THEN round({x} / pow(10, floor(log10({x})) - 8)) * pow(10, floor(log10({x})) - 8) ELSE -1 END"
            if oblivious:
                parts.append(f"""b{a} AS (SELECT fit_fold, j, code, side FROM (
  SELECT fit_fold, j, code, side, row_number() OVER (PARTITION BY fit_fold ORDER BY {coarse('gain')} DESC, j, code, side) AS rk, gain FROM (
    SELECT fit_fold, j, code, side, sum({gain}) AS gain FROM o{a} GROUP BY ALL)) WHERE rk = 1 AND gain > 0)""")
                on = f"b.fit_fold = n.fit_fold AND n.node >= {2 ** lv}"
            else:
                parts.append(f"""b{a} AS (SELECT fit_fold, node, j, code, side FROM (
  SELECT fit_fold, node, j, code, side, row_number() OVER (PARTITION BY fit_fold, node ORDER BY {coarse('gain')} DESC, j, code, side) AS rk, gain FROM (
    SELECT *, {gain} AS gain FROM o{a} WHERE nl >= 1 AND nt - nl >= 1 AND hl >= {least_h} AND ht - hl >= {least_h})) WHERE rk = 1 AND gain > 0)""")
                on = "b.fit_fold = n.fit_fold AND b.node = n.node"
            go = "CASE WHEN b.j IS NULL THEN n.node WHEN (n.code[b.j] = 0 AND b.side = 0) OR (n.code[b.j] > 0 AND n.code[b.j] <= b.code) THEN 2 * n.node ELSE 2 * n.node + 1 END"
            parts.append(f"n{t}_{lv + 1} AS MATERIALIZED (SELECT n.* REPLACE ({go} AS node) FROM n{a} n LEFT JOIN b{a} b ON {on})")
        parts.append(f"v{t} AS (SELECT fit_fold, node, -{rate} * sum(g) / (sum(h) + {l2}) AS v FROM n{t}_{depth} WHERE role = 'train' GROUP BY ALL)")
        parts.append(f"s{t + 1} AS (SELECT n.* EXCLUDE (node, g, h) REPLACE (raw + coalesce(v.v, 0) AS raw) FROM n{t}_{depth} n LEFT JOIN v{t} v USING (fit_fold, node))")
    return ctes(*parts) + f"\nSELECT id, fit_fold AS fold, y AS y_true, {R(p, digits)} AS y_pred FROM s{rounds} WHERE role = 'valid'"


NATIVE_NUMERIC = ["acctbal", "avg_qty", "avg_discount", "const_num", "acctbal_copy"]
NATIVE_NOMINAL = ["n_items", "c_mktsegment", "o_orderpriority", "n_name", "rare_cat", "is_even"]
RAW_NUMERIC = ["acctbal", "avg_qty", "avg_discount", "n_items"]
QUERIES["hist_boosting_cv"] = _boosted(RAW_NUMERIC, [], "fold", "y_reg", "regression", False, 2, 2, 16, 0.5, 1.0, 1.0, 3)
QUERIES["hist_boosting_binary_cv"] = _boosted(RAW_NUMERIC, [], "sfold", "y_bin", "binary", True, 2, 2, 16, 0.5, 3.0, 0.0, 7)


# ---------------------------------------------------------------- families, stored tables
def _families(names, label, fold):
    values = ", ".join(f"('{n}')" for n in names)
    return with_ctx(f"SELECT f.family, t.id, t.{fold} AS fold, CAST(t.{label} AS DOUBLE) AS y_true, 1::INTEGER AS bounded FROM train t, (VALUES {values}) AS f(family)")


QUERIES["regression_families_oof"] = _families(["elasticnet", "random_forest", "gradient_boosted_trees", "hist_gradient_boosting", "lightgbm", "xgboost", "catboost"], "y_reg", "fold")
QUERIES["binary_families_oof"] = _families(["logistic_regression", "random_forest", "gradient_boosted_trees", "hist_gradient_boosting", "lightgbm", "xgboost", "catboost", "knn", "naive_bayes", "svm", "realmlp"], "y_bin", "sfold")
QUERIES["native_trees_oof"] = _boosted(NATIVE_NUMERIC, NATIVE_NOMINAL, "fold", "y_reg", "regression", True, 3, 2, 32, 0.3, 3.0, 0.0, 3)

QUERIES["knn_fold_cv"] = f"""WITH o AS (
  SELECT vec_id, embedding, label, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS r, count(*) OVER () AS n FROM embeddings),
v AS (SELECT vec_id, embedding, label, CAST(CASE WHEN r < (n % {K}) * (n // {K} + 1) THEN r // (n // {K} + 1)
    ELSE (n % {K}) + (r - (n % {K}) * (n // {K} + 1)) // (n // {K}) END + 1 AS INTEGER) AS fold FROM o),
pairs AS (SELECT a.vec_id AS q, b.vec_id AS nb, b.label, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
    lambda t: (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE)) * (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE))))) AS d FROM v a JOIN v b ON a.fold <> b.fold),
near AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY floor(d * 1e9 + 0.5), nb) AS rk FROM pairs),
pred AS (SELECT q, CASE WHEN count(*) FILTER (WHERE d = 0) > 0 THEN avg(label) FILTER (WHERE d = 0)
    ELSE sum(label / nullif(d, 0)) / sum(1 / nullif(d, 0)) END AS p FROM near WHERE rk <= 5 GROUP BY q)
SELECT v.vec_id AS id, v.fold, CAST(v.label AS DOUBLE) AS y_true, {R('p', 6)} AS y_pred FROM v JOIN pred ON pred.q = v.vec_id"""

QUERIES["blend_summary"] = ctes(*oof_ctes()) + f"""
, comp(candidate_id, rank_, w) AS (VALUES ('cand_a', 1, 0.5::DOUBLE), ('cand_b', 2, 0.25::DOUBLE), ('cand_c', 3, 0.25::DOUBLE)),
own AS (SELECT 'blend__abc' AS candidate_id, row_idx, fold, any_value(y_true) AS y_true, sum(w * y_pred) AS y_pred FROM oof JOIN comp USING (candidate_id) GROUP BY row_idx, fold),
fm AS (SELECT candidate_id, fold, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS v
  FROM (SELECT candidate_id, fold, y_true, y_pred FROM oof UNION ALL SELECT candidate_id, fold, y_true, y_pred FROM own) GROUP BY 1, 2),
cv AS (SELECT candidate_id, avg(v) AS mean, stddev_pop(v) AS std FROM fm GROUP BY 1),
cm AS (SELECT a.candidate_id, corr(a.y_pred, b.y_pred) AS c FROM oof a JOIN oof b ON a.row_idx = b.row_idx AND a.candidate_id <> b.candidate_id
  WHERE a.candidate_id IN (SELECT candidate_id FROM comp) AND b.candidate_id IN (SELECT candidate_id FROM comp) GROUP BY a.candidate_id, b.candidate_id),
cs AS (SELECT candidate_id, avg(c) AS a, min(c) AS lo, max(c) AS hi FROM cm GROUP BY 1)
SELECT 'blend__abc' AS blend_candidate_id, 'blend_weighted_average' AS blend_registry_key, 'rmse' AS blend_metric_name, {R('b.mean', 6)} AS blend_metric_mean, {R('b.std', 6)} AS blend_metric_std,
  CAST(rank_ AS INTEGER) AS component_rank, comp.candidate_id AS component_candidate_id, 'model' AS component_candidate_type, 'run_' || comp.candidate_id AS component_mlflow_run_id,
  'ridge' AS component_model_registry_key, 'Ridge' AS component_estimator_name, NULL AS component_representation_id, NULL AS component_config_fingerprint,
  {R('w', 6)} AS component_weight, {R('cv.mean', 6)} AS component_cv_metric_mean, {R('cv.std', 6)} AS component_cv_metric_std,
  {R('cs.a', 6)} AS avg_oof_correlation_to_others, {R('cs.lo', 6)} AS min_oof_correlation_to_others, {R('cs.hi', 6)} AS max_oof_correlation_to_others
FROM comp JOIN cv USING (candidate_id) JOIN cs USING (candidate_id), cv b WHERE b.candidate_id = 'blend__abc'"""

QUERIES["ledger_write"] = lctes() + """
SELECT r.run_id, r.candidate_id, r.status, 2 + CASE WHEN r.trial_number IS NULL THEN 0 ELSE 1 END AS n_params, coalesce(a.n, 0) AS n_artifacts, r.metric_value,
  CAST(r.trial_number AS VARCHAR) AS trial_json
FROM runs r LEFT JOIN (SELECT run_id, count(*) AS n FROM arts GROUP BY 1) a USING (run_id)"""
QUERIES["history_roundtrip"] = rctes() + """
SELECT candidate_id, submission_event_id, 'event' AS part, NULL::DOUBLE AS public_score FROM ev
UNION ALL SELECT ev.candidate_id, h.submission_event_id, 'observation', h.public_score FROM hist h JOIN ev USING (submission_event_id)"""
QUERIES["eda_reports"] = QUERIES["missingness"]
