"""Interaction operators.

Column eligibility ("at most ``max_cardinality`` distinct non-null values") is
decided per fit fold from the complement statistics, so a column can take part
in one fold's crosses and not another's; an ineligible pair yields NULL (dense)
or no entry (sparse) in that fold.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.scalar import BIN_PREFIX, CROSS_SEPARATOR, DEVIATION_EPSILON, MISSING_TOKEN, observed, per_fold
from foldwise.operators import stats as st
from foldwise.operators.base import FIT_FOLD, Fitted, LongForm
from foldwise.operators.categorical import CategoryStats, low_cardinality, text
from foldwise.operators.numeric import NumericStats, bin_edges, bin_index


def cross_name(a: str, b: str) -> str:
    return f"{a}{CROSS_SEPARATOR}{b}"


def cross_pairs(eligible: dict) -> tuple[list, dict]:
    """Candidate pairs (column order) and {pair: folds where both are eligible}."""
    folds_of: dict = {}
    for f, cols in eligible.items():
        for a, b in itertools.combinations(cols, 2):
            folds_of.setdefault((a, b), []).append(f)
    order = sorted(folds_of, key=lambda p: (min(_pos(eligible, p[0])), min(_pos(eligible, p[1]))))
    return order, folds_of


def _pos(eligible, c):
    return [cols.index(c) for cols in eligible.values() if c in cols]


def with_crosses(df: DataFrame, pairs: list, like: DataFrame | None = None, missing: str = MISSING_TOKEN) -> DataFrame:
    """Adds ``a__x__b`` = text(a) || '__x__' || text(b) for each pair."""
    like = like if like is not None else df
    return df.select("*", *[F.concat(text(like, a, missing), F.lit(CROSS_SEPARATOR), text(like, b, missing))
                            .alias(cross_name(a, b)) for a, b in pairs])


def _eligible_in(folds: list) -> F.Column:
    return F.col(FIT_FOLD).isin(*folds)


class CrossPlan:
    """Eligible pairs per fold plus complement statistics of the crossed values."""

    def __init__(self, cs: CategoryStats, max_cardinality: int):
        self.cs = cs
        fits = list(range(1, cs.k + 1))
        self.eligible = low_cardinality(cs.nunique(), cs.cols, max_cardinality, fits)
        self.pairs, self.folds_of = cross_pairs(self.eligible)
        self.names = [cross_name(a, b) for a, b in self.pairs]
        if self.pairs:
            crossed = with_crosses(cs.train, self.pairs, missing=cs.missing)
            # a crossed value is a pair of categories, of which each side has at most max_cardinality
            # non-null ones in some fold, so its number is bounded before anything is counted
            per_side = 1 + cs.k * max_cardinality
            self.stats = CategoryStats(crossed, self.names, cs.k, cs.fold_col, None, cs.missing,
                                       card={name: per_side * per_side for name in self.names})
        else:
            self.stats = None

    def prepare(self, rows: DataFrame) -> DataFrame:
        return with_crosses(rows, self.pairs, like=self.cs.train, missing=self.cs.missing) if self.pairs else rows


def fit_cross_categoricals(plan: CrossPlan, op: str = "cross_low_cardinality_categoricals") -> Fitted:
    """F17 (sparse): one indicator per crossed value seen in the fit rows."""
    cols, lookups = {}, []
    for (a, b), name in zip(plan.pairs, plan.names):
        lk = f"_lk_x_{name}"
        lookups.append(plan.stats.lookup(name, F.lit(True), lk))
        hit = F.element_at(F.col(lk), F.col(FIT_FOLD))
        cols[f"{op}__{name}"] = F.when(_eligible_in(plan.folds_of[(a, b)]) & hit,
                                       F.concat(F.lit(f"{op}__{op}__{name}_"), F.col(name)))
    return Fitted(cols, lookups)


def fit_frequency_crosses(plan: CrossPlan, op: str = "frequency_encode_categorical_crosses") -> Fitted:
    """share of the crossed value in the fit rows; unseen -> 0; ineligible -> NULL."""
    rows = {f: float(n) for f, (n, _) in plan.cs.totals.items()}
    n_fit = per_fold(FIT_FOLD, rows)
    cols, lookups, entries = {}, [], []
    for i, ((a, b), name) in enumerate(zip(plan.pairs, plan.names)):
        lk = f"_lk_fx_{name}"
        lookups.append(plan.stats.lookup(name, F.col("n").cast("double"), lk))
        share = F.coalesce(F.element_at(F.col(lk), F.col(FIT_FOLD)) / n_fit, F.lit(0.0))
        cols[f"{op}__{name}"] = F.when(_eligible_in(plan.folds_of[(a, b)]), share)
        entries += [{FIT_FOLD: f, "feature": f"{op}__{name}", "_pair": i, "_n": rows[f]} for f in plan.folds_of[(a, b)]]
    per_row = {"_pairs": F.array(*[F.col(f"_lk_fx_{name}") for name in plan.names])}
    value = F.coalesce(F.get(F.get("_pairs", F.col("_pair")), F.col(FIT_FOLD) - 1) / F.col("_n"), F.lit(0.0))
    return Fitted(cols, lookups, long=LongForm(per_row, sorted(entries, key=lambda e: e[FIT_FOLD]), value))


def fit_cross_binned(ns: NumericStats, cs: CategoryStats, n_bins: int = 5, max_cardinality: int = 10,
                     op: str = "cross_categorical_with_binned_numeric") -> Fitted:
    """F18 (sparse): quantile bin of each numeric column crossed with each
    eligible categorical column; one indicator per crossed value seen in the fit.

    The fit's crossed values come from the unexpanded training rows: per category and fold, the bins under
    every fit's edges as bits, which are then merged over the folds outside each fit. The lookup is keyed by
    category and holds these bits by fit fold and numeric column, and the names of its crossed values.
    """
    fits = list(range(1, cs.k + 1))
    eligible = low_cardinality(cs.nunique(), cs.cols, max_cardinality, fits)
    cats = [c for c in cs.cols if any(c in eligible[f] for f in fits)]
    nums = ns.cols
    if not cats or not nums:
        return Fitted({}, long=LongForm({}, [], F.lit(1.0)))
    edges = bin_edges(ns, n_bins)
    inner = {key: e[1:-1] for key, e in edges.items()}
    width, words = max(len(e) for e in inner.values()), -(-n_bins // WORD)
    inner = {key: [*e, *[float("inf")] * (width - len(e))] for key, e in inner.items()}
    medians = {x: ns.median_of(x) for x in nums}
    marks = {}
    for f in fits:
        for x in nums:
            b = _bin(F.coalesce(observed(x), F.lit(medians[x][f])), [F.lit(e) for e in inner[(x, f)]])
            for w in range(words):
                marks[(f, x, w)] = F.when(F.floor(b / WORD) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), (b % WORD).cast("int"))).otherwise(F.lit(0).cast("bigint"))
    name = {key: f"_m{i}" for i, key in enumerate(marks)}
    values = F.array(*[F.struct(F.lit(c).alias("key"), text(cs.train, c, cs.missing).alias("v")) for c in cats])
    fold, keys, parts = F.col(cs.fold_col).cast("int").alias("_fold"), list(marks), []
    for start in range(0, len(keys), MARKS_A_SCAN):
        some = keys[start:start + MARKS_A_SCAN]
        marked = cs.train.select(fold, values.alias("_vs"), *[marks[key].alias(name[key]) for key in some])
        parts.append(marked.select("_fold", F.inline("_vs"), *[name[key] for key in some]).groupBy("key", "v", "_fold").agg(*[F.bit_or(name[key]).alias(name[key]) for key in some]))
    # categories x folds rows a scan
    seen = functools.reduce(lambda p, q: p.unionByName(q, allowMissingColumns=True), parts).persist()
    cs.cached.append(seen)
    cols, lookups, entries = {}, [], []
    for c in cats:
        folds = [f for f in fits if c in eligible[f]]
        lk = f"_lk_xb_{c}"
        outside = [F.coalesce(F.bit_or(F.when(F.col("_fold") != key[0], F.col(n))), F.lit(0).cast("bigint")) for key, n in name.items()]
        names = [F.concat(F.lit(f"{op}__{op}__{x}{CROSS_SEPARATOR}{c}_{BIN_PREFIX}{b}{CROSS_SEPARATOR}"), F.col("v")) for x in nums for b in range(n_bins)]
        table = (seen.where(F.col("key") == c).groupBy("v").agg(F.array(*outside).alias(lk))
                 .select(F.col("v").alias(f"{lk}_k"), lk, F.array(*names).alias(f"{lk}_names")))

        def cond(df, t, c=c, lk=lk):
            return text(cs.train, c, cs.missing) == t[f"{lk}_k"]
        lookups.append((table, cond, cs.broadcastable(c)))
        for i, x in enumerate(nums):
            b = bin_index(ns.imputed(x), {f: edges[(x, f)] for f in fits})
            at = ((F.col(FIT_FOLD) - 1) * len(nums) + i) * words
            cols[f"{op}__{x}__x__{c}"] = F.when(_eligible_in(folds) & _marked(F.col(lk), at, b), F.get(f"{lk}_names", b + i * n_bins))
            entries += [{FIT_FOLD: f, "_c": cats.index(c), "_x": i, "_at": ((f - 1) * len(nums) + i) * words, "_median": medians[x][f],
                         **{f"_e{j}": e for j, e in enumerate(inner[(x, f)])}} for f in folds]
    # keep the historical column order: numeric-major
    order = [f"{op}__{x}__x__{c}" for x in nums for c in cats]
    per_row = {"_xs": F.array(*[observed(x) for x in nums]), "_seen": F.array(*[F.col(f"_lk_xb_{c}") for c in cats]),
               "_names": F.array(*[F.col(f"_lk_xb_{c}_names") for c in cats])}
    b = _bin(F.coalesce(F.get("_xs", F.col("_x")), F.col("_median")), [F.col(f"_e{j}") for j in range(width)])
    long = LongForm(per_row, sorted(entries, key=lambda e: e[FIT_FOLD]), F.lit(1.0), has=_marked(F.get("_seen", F.col("_c")), F.col("_at"), b),
                    feature=F.get(F.get("_names", F.col("_c")), F.col("_x") * n_bins + b))
    return Fitted({n: cols[n] for n in order}, lookups, long=long)


#: Bins that one word of bits marks, and words that one scan sets (more make a method that the JVM leaves uncompiled).
WORD, MARKS_A_SCAN = 63, 10


def _bin(x, inner: list):
    """Number of inner edges <= x."""
    count = F.lit(0)
    for e in inner:
        count = count + F.when(x >= e, 1).otherwise(0)
    return count


def _marked(bits, at, b):
    """Whether bin b is marked in the words that begin at that place of ``bits``."""
    return F.coalesce(F.getbit(F.get(bits, at + F.floor(b / WORD).cast("int")), (b % WORD).cast("int")) == 1, F.lit(False))


def fit_group_deviation(ns: NumericStats, cs: CategoryStats, max_cardinality: int = 20,
                        op: str = "groupwise_deviation_features") -> Fitted:
    """(x - group mean) / (group sample std + 1e-8) on median-imputed x;
    a one-row group has std 0; an unseen group uses the fit's global mean and
    sample std."""
    fits = list(range(1, cs.k + 1))
    eligible = low_cardinality(cs.nunique(), cs.cols, max_cardinality, fits)
    cats = [c for c in cs.cols if any(c in eligible[f] for f in fits)]
    nums = ns.cols
    shifts = {c: ns.moments[(c, 1)][0] for c in nums}
    cols, lookups, entries = {}, [], []
    for c in cats:
        g = cs.train.select(F.col(cs.fold_col), text(cs.train, c, cs.missing).alias("v"), *[observed(x).alias(x) for x in nums])
        partial, combine = {"rows": F.count(F.lit(1))}, {"rows": "sum"}
        for x in nums:
            d = F.col(x) - F.lit(shifts[x])
            partial.update({f"{x}_nn": F.count(x), f"{x}_sx": F.sum(x), f"{x}_s1": F.sum(d),
                            f"{x}_s2": F.sum(d * d), f"{x}_mn": F.min(x), f"{x}_mx": F.max(x)})
            combine.update({f"{x}_nn": "sum", f"{x}_sx": "sum", f"{x}_s1": "sum", f"{x}_s2": "sum",
                            f"{x}_mn": "min", f"{x}_mx": "max"})
        comp = st.complement_groups(g, ["v"], cs.k, partial, combine, cs.fold_col)
        vals = []
        n = F.col("rows").cast("double")
        for x in nums:
            m = per_fold(FIT_FOLD, ns.median_of(x))
            z = n - F.col(f"{x}_nn")
            dm = m - F.lit(shifts[x])
            s1 = F.coalesce(F.col(f"{x}_s1"), F.lit(0.0)) + z * dm
            s2 = F.coalesce(F.col(f"{x}_s2"), F.lit(0.0)) + z * dm * dm
            lo = F.least(F.col(f"{x}_mn"), F.when(z > 0, m))
            hi = F.greatest(F.col(f"{x}_mx"), F.when(z > 0, m))
            same = lo == hi
            sum_imp = F.coalesce(F.col(f"{x}_sx"), F.lit(0.0)) + z * m
            mean = F.when(same, lo).otherwise(sum_imp / n)
            var = F.greatest((s2 - s1 * s1 / n) / (n - 1), F.lit(0.0))
            std = F.when(same | (n <= 1), F.lit(0.0)).otherwise(F.sqrt(var))
            vals += [mean.alias(f"{x}_mean"), std.alias(f"{x}_std")]
        comp = comp.select("v", FIT_FOLD, F.array(*vals).alias("val"))
        lk = f"_lk_gd_{c}"
        # one array a category: by fit fold, then numeric column, its mean and std (nulls where the fit has no such group)
        table = comp.groupBy("v").agg(F.map_from_entries(F.collect_list(F.struct(FIT_FOLD, "val"))).alias("m"))
        none = F.array_repeat(F.lit(None).cast("double"), 2 * len(nums))
        table = table.select(F.col("v").alias(f"{lk}_k"), F.flatten(F.array(*[F.coalesce(F.element_at("m", F.lit(f)), none) for f in fits])).alias(lk))

        def cond(df, t, c=c, lk=lk):
            return text(cs.train, c, cs.missing) == t[f"{lk}_k"]
        lookups.append((table, cond, cs.broadcastable(c)))
        folds = [f for f in fits if c in eligible[f]]
        for i, x in enumerate(nums):
            gm = {f: ns.moments[(x, f)][0] for f in fits}
            gs = {f: _sqrt_or_nan(ns.moments[(x, f)][2]) for f in fits}
            at = (F.col(FIT_FOLD) - 1) * (2 * len(nums)) + 2 * i
            dev = _deviation(ns.imputed(x), F.col(lk), at, per_fold(FIT_FOLD, gm), per_fold(FIT_FOLD, gs))
            name = f"{op}__{x}_dev_by_{c}"
            cols[name] = F.when(_eligible_in(folds), dev)
            entries += [{FIT_FOLD: f, "feature": name, "_c": cats.index(c), "_x": i, "_at": (f - 1) * 2 * len(nums) + 2 * i,
                         "_median": ns.median_of(x)[f], "_mean": gm[f], "_std": gs[f]} for f in folds]
    per_row = {"_xs": F.array(*[observed(x) for x in nums]), "_groups": F.array(*[F.col(f"_lk_gd_{c}") for c in cats])}
    value = _deviation(F.coalesce(F.get("_xs", F.col("_x")), F.col("_median")), F.get("_groups", F.col("_c")), F.col("_at"), F.col("_mean"), F.col("_std"))
    return Fitted(cols, lookups, long=LongForm(per_row, sorted(entries, key=lambda e: e[FIT_FOLD]), value))


def _deviation(x, group, at, mean, std):
    """x against its group's mean and std at place ``at`` of the lookup, or the fit's own where it has no such group."""
    return (x - F.coalesce(F.get(group, at), mean)) / (F.coalesce(F.get(group, at + 1), std) + F.lit(DEVIATION_EPSILON))


def _sqrt_or_nan(v):
    import math
    return math.sqrt(v) if v == v and v >= 0 else float("nan")
