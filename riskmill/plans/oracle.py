"""The registered queries as SQL over the same tables, for an independent check."""

from __future__ import annotations

from riskmill.operators.curves import threshold_grid
from riskmill.sources.loans import RAW_LOANS_SQL
from riskmill.spec import LOANS, SEED

LABEL, KEY = LOANS.label, LOANS.key

# The columns of the loan view in order.
RAW_COLUMNS = [
    "id", "member_id", "loan_amnt", "funded_amnt", "term", "int_rate", "installment",
    "annual_inc", "dti", "delinq_2yrs", "inq_last_6mths", "revol_util", "open_acc", "pub_rec",
    "revol_bal", "total_acc", "collections_12_mths_ex_med", "acc_now_delinq", "tot_coll_amt",
    "tot_cur_bal", "total_rev_hi_lim", "grade", "sub_grade", "home_ownership", "purpose",
    "verification_status", "emp_length", "application_type", "addr_state", "sparse_col",
    "description", "total_pymnt", "policy_code", "default_ind", "score",
]
RAW_TEXT = [
    "term", "annual_inc", "delinq_2yrs", "inq_last_6mths", "revol_util", "grade", "sub_grade",
    "home_ownership", "purpose", "verification_status", "emp_length", "application_type",
    "addr_state", "sparse_col", "description",
]
RAW_INTEGERS = [
    "id", "member_id", "open_acc", "pub_rec", "total_acc", "collections_12_mths_ex_med",
    "acc_now_delinq", "policy_code", "default_ind",
]
CLEAN_TEXT = [c for c in RAW_TEXT if c not in [*LOANS.lenient_casts, "term", "revol_util"]]
CLEAN_NUMBERS = [c for c in RAW_COLUMNS if c not in CLEAN_TEXT]
CLEAN_INTEGERS = [
    "id", "member_id", "term", "collections_12_mths_ex_med", "acc_now_delinq", "policy_code",
    "default_ind",
]
PREDICTORS = [c for c in CLEAN_NUMBERS if c not in LOANS.non_predictors]


def _list(names):
    return ", ".join(names)


TERM = "TRY_CAST(trim(regexp_replace(term, 'months', '', 'g')) AS INTEGER)"
PERCENT = "TRY_CAST(regexp_replace(revol_util, '%', '', 'g') AS DOUBLE)"
CASTS = {c: f"TRY_CAST({c} AS {'INTEGER' if t == 'int' else 'DOUBLE'})"
         for c, t in LOANS.lenient_casts.items()}
PARSED = {**CASTS, "term": TERM, "revol_util": PERCENT}
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in LOANS.core)


def _replace(expressions):
    return ", ".join(f"{e} AS {c}" for c, e in expressions.items())


RAW = f"WITH raw_loans AS ({RAW_LOANS_SQL})"
TYPED = f"{RAW}, typed AS (SELECT * REPLACE ({_replace(PARSED)}) FROM raw_loans)"
CLEAN = (
    f"{TYPED}, target AS (SELECT * FROM typed WHERE {LABEL} IS NOT NULL)"
    f", clean AS (SELECT * FROM target WHERE {COMPLETE})"
)

GRADE = "CASE {0} WHEN 'A' THEN 1e0 WHEN 'B' THEN 2e0 WHEN 'C' THEN 3e0 WHEN 'D' THEN 4e0" \
        " WHEN 'E' THEN 5e0 WHEN 'F' THEN 6e0 WHEN 'G' THEN 7e0 ELSE 4e0 END"
RATIOS = {n: f"CASE WHEN {d} > 0 THEN {t} / {d} END" for n, (t, d) in LOANS.ratios.items()}
NONZERO = {n: f"CASE WHEN {d} <> 0 THEN {t} / {d} END" for n, (t, d) in LOANS.ratios.items()}
PRODUCTS = {n: f"{a} * {b}" for n, (a, b) in LOANS.interactions.items()}


def _capped(ratios):
    return {
        n: f"CASE WHEN {r} > {LOANS.ratio_caps[n]} THEN {LOANS.ratio_caps[n]}e0 ELSE {r} END"
        if n in LOANS.ratio_caps else r
        for n, r in ratios.items()
    }


def _columns(expressions, digits=None):
    return ", ".join(
        f"{e} AS {n}" if digits is None else f"round({e}, {digits}) AS {n}"
        for n, e in expressions.items()
    )


def _known(blank_is_missing=True):
    text = "nullif({0}, '')" if blank_is_missing else "{0}"
    return ", ".join(
        f"coalesce({text.format(c)}, 'UNKNOWN') AS {c}" for c in LOANS.categorical
    )


def _prepared(ratios, blank_is_missing=True, grade="grade"):
    numbers = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in [*LOANS.numeric, LABEL])
    required = " AND ".join(f"{c} IS NOT NULL" for c in [*LOANS.model_numeric, LABEL])
    return (
        f"{CLEAN}, doubles AS (SELECT {KEY}, {numbers}, {_known(blank_is_missing)} FROM clean)"
        f", ranked AS (SELECT *, {GRADE.format(grade)} AS grade_ord FROM doubles)"
        f", engineered AS (SELECT *, {_columns(ratios)}, {_columns(PRODUCTS)} FROM ranked)"
        f", prepared AS (SELECT * FROM engineered WHERE {required})"
    )


PREPARED = _prepared(RATIOS)


def _hash(salt=""):
    text = f"md5(concat_ws('|', CAST({KEY} AS VARCHAR), '{SEED}{salt}'))"
    return f"(CAST('0x' || substr({text}, 1, 8) AS BIGINT) / 4294967296e0)"


SPLIT_CASE = (
    f"CASE WHEN {_hash()} < 0.64 THEN 'train' WHEN {_hash()} < 0.8 THEN 'val' ELSE 'test' END"
)
RATE = (
    f"count(*) AS n, CAST(count(*) FILTER (WHERE {LABEL} = 1) AS DOUBLE) / count(*) AS rate"
)
RATES_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS category, {RATE} FROM clean GROUP BY {c}"
    for c in LOANS.rate_columns
)


def _null_profile(source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count,"
        f" CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_share FROM {source}"
        for c in RAW_COLUMNS
    )


def _correlations(source, names, zero=False):
    value = "coalesce(CAST({0} AS DOUBLE), 0)" if zero else "CAST({0} AS DOUBLE)"
    pairs = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN stddev_pop(CASE WHEN {value.format(LABEL)} IS NOT NULL"
        f" THEN {value.format(c)} END) > 0 THEN corr({value.format(c)}, {value.format(LABEL)}) END"
        f" AS r FROM {source}"
        for c in names
    )
    return f"SELECT feature, round(r, 4) AS correlation FROM ({pairs}) WHERE r IS NOT NULL"


SCORED_PREDICTORS = [c for c in PREDICTORS if c != "score"]

# Evaluation over (label, score)
PAIRS = (
    f"{RAW}, scored AS (SELECT {KEY}, {LABEL}, score, int_rate / 25e0 AS rate_score,"
    f" {SPLIT_CASE} AS split FROM raw_loans)"
)


def _curve(source, score, prefix=""):
    """Running counts per distinct score, as CTEs."""
    return (
        f", {prefix}tied AS (SELECT {score} AS score,"
        f" count(*) FILTER (WHERE {LABEL} = 1) AS pos, count(*) FILTER (WHERE {LABEL} = 0) AS neg"
        f" FROM {source} WHERE {LABEL} IN (0, 1) AND {score} IS NOT NULL GROUP BY {score})"
        f", {prefix}run AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,"
        f" sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM {prefix}tied"
        f" WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"
    )


ROC_AREA = "sum(neg * (tp - pos / 2e0)) / (max(p) * CAST(max(n) AS DOUBLE))"
PR_AREA = (
    "sum(CAST(pos AS DOUBLE) * (tp / CAST(tp + fp AS DOUBLE) + CASE WHEN tp - pos + fp - neg > 0"
    " THEN (tp - pos) / CAST(tp - pos + fp - neg AS DOUBLE)"
    " ELSE tp / CAST(tp + fp AS DOUBLE) END) / 2) / max(p)"
)
AVERAGE_PRECISION = "sum(CAST(pos AS DOUBLE) * (tp / CAST(tp + fp AS DOUBLE))) / max(p)"

GRID = ", ".join(repr(t) + "::DOUBLE" for t in threshold_grid())


def _ratio0(top, bottom):
    return f"coalesce(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 0e0)"


def _sweep(source, score, prefix=""):
    """Counts and rates at every threshold, by comparing every distinct score with every threshold."""
    total = "coalesce(CAST(sum({0}) FILTER (WHERE s {1} threshold) AS BIGINT), 0)"
    return (
        f", {prefix}tallied AS (SELECT {score} AS s, count(*) FILTER (WHERE {LABEL} = 1) AS one,"
        f" count(*) FILTER (WHERE {LABEL} = 0) AS zero FROM {source} GROUP BY {score})"
        f", {prefix}hits AS (SELECT threshold, {total.format('one', '>=')} AS tp,"
        f" {total.format('zero', '>=')} AS fp, {total.format('one', '<')} AS fn"
        f" FROM (SELECT unnest([{GRID}]) AS threshold), {prefix}tallied GROUP BY threshold)"
        f", {prefix}rated AS (SELECT threshold, tp, fp, fn,"
        f" {_ratio0('tp', 'tp + fp')} AS precision, {_ratio0('tp', 'tp + fn')} AS recall"
        f" FROM {prefix}hits)"
        f", {prefix}sweep AS (SELECT *, coalesce(2 * precision * recall"
        f" / nullif(precision + recall, 0), 0e0) AS f1 FROM {prefix}rated)"
        f", {prefix}best AS (SELECT threshold, f1 FROM {prefix}sweep"
        f" ORDER BY f1 DESC, threshold LIMIT 1)"
    )


def _cells(label, prediction):
    def cell(name, a, p):
        return f"count(*) FILTER (WHERE {label} = {a} AND {prediction} = {p}) AS {name}"

    return ", ".join([cell("tp", 1, 1), cell("tn", 0, 0), cell("fp", 0, 1), cell("fn", 1, 0)])


F1 = "coalesce(2 * precision * recall / nullif(precision + recall, 0), 0e0) AS f1"
CLASS = f"{_ratio0('tp', 'tp + fp')} AS precision, {_ratio0('tp', 'tp + fn')} AS recall"
OVERALL = {
    "accuracy": _ratio0("tp + tn", "tp + tn + fp + fn"),
    "precision_weighted": (
        f"{_ratio0('tp + fn', 'tp + tn + fp + fn')} * {_ratio0('tp', 'tp + fp')}"
        f" + {_ratio0('tn + fp', 'tp + tn + fp + fn')} * {_ratio0('tn', 'tn + fn')}"
    ),
    "recall_weighted": (
        f"{_ratio0('tp + fn', 'tp + tn + fp + fn')} * {_ratio0('tp', 'tp + fn')}"
        f" + {_ratio0('tn + fp', 'tp + tn + fp + fn')} * {_ratio0('tn', 'tn + fp')}"
    ),
}


def _predicted(score, cut="0.5"):
    return f"CASE WHEN {score} >= {cut} THEN 1e0 ELSE 0e0 END"


HALF = (
    f"{PAIRS}, counts AS (SELECT {_cells(LABEL, _predicted('score'))} FROM scored)"
)

SCORES = {"planted": "score", "rate": "rate_score"}


def _evaluations(tuned, part="test", name="evals"):
    """One row per scored model, as CTEs ending in ``name``."""
    ctes, rows = "", []
    for model, score in SCORES.items():
        p = f"{name}_{model}_"
        ctes += f", {p}val AS (SELECT * FROM scored WHERE split = 'val')"
        ctes += f", {p}part AS (SELECT * FROM scored WHERE split = '{part}')"
        ctes += _sweep(f"{p}val", score, p) + _curve(f"{p}part", score, p)
        cut = f"(SELECT threshold FROM {p}best)" if tuned else "0.5"
        chosen = f"(SELECT f1 FROM {p}best)" if tuned else "CAST(NULL AS DOUBLE)"
        ctes += (
            f", {p}cells AS (SELECT {_cells(LABEL, _predicted(score, cut))} FROM {p}part)"
            f", {p}class AS (SELECT *, {CLASS}, {_columns(OVERALL, 6)} FROM {p}cells)"
        )
        rows.append(
            f"SELECT '{model}' AS model, 'prediction' AS prediction_column,"
            f" CAST({cut} AS DOUBLE) AS threshold, accuracy, precision_weighted, recall_weighted,"
            f" (SELECT round({ROC_AREA}, 6) FROM {p}run) AS auc_roc,"
            f" (SELECT round({PR_AREA}, 6) FROM {p}run) AS auc_pr,"
            f" (SELECT count(*) FROM scored WHERE split = 'train' AND {LABEL} IN (0, 1)) AS train_rows,"
            f" tp + tn + fp + fn AS test_rows, tp, tn, fp, fn, precision, recall, {F1},"
            f" {chosen} AS validation_f1 FROM {p}class"
        )
    return f"{ctes}, {name} AS ({' UNION ALL '.join(rows)})"


PLAIN, TUNED = _evaluations(False, name="plain"), _evaluations(True, name="tuned")
ROUNDED_METRICS = ", ".join(
    f"round({c}, 4) AS {c}" for c in (
        "threshold", "accuracy", "precision_weighted", "recall_weighted", "auc_roc", "auc_pr",
        "precision", "recall", "f1",
    )
)


def _histogram(per_class):
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {LABEL} AS label, CAST({c} AS DOUBLE) AS v FROM clean"
        f" WHERE {LABEL} IN (0, 1) AND {c} IS NOT NULL"
        for c in LOANS.histogram_columns
    )
    group = "feature, label" if per_class else "feature"
    return (
        f"{CLEAN}, long AS ({rows}), ranged AS (SELECT *, min(v) OVER (PARTITION BY {group}) AS lo,"
        f" max(v) OVER (PARTITION BY {group}) AS hi FROM long)"
        f", placed AS (SELECT feature, label, lo, hi, least(CAST(floor(CASE WHEN hi > lo THEN"
        f" (v - lo) * 40 / (hi - lo) ELSE 0 END) AS INTEGER), 39) AS bin FROM ranged)"
        f" SELECT feature, label, bin, round(lo + bin * (hi - lo) / 40, 6) AS bin_start,"
        f" round(lo + (bin + 1) * (hi - lo) / 40, 6) AS bin_end, count(*) AS n"
        f" FROM placed GROUP BY feature, label, lo, hi, bin"
    )


def _slots(source, numeric, unknown_slots=True):
    """Sum of every vector slot."""
    parts = [f"SELECT '{c}' AS feature, round(sum({c}), 2) AS total FROM {source}" for c in numeric]
    for c in LOANS.categorical if unknown_slots else ():
        parts.append(
            f"SELECT '{c}=' || {c} AS feature, CAST(count(*) AS DOUBLE) AS total FROM {source} GROUP BY {c}"
        )
        parts.append(f"SELECT '{c}=__unknown', 0e0")
    return " UNION ALL ".join(parts)


def _slots_by_part():
    """Sum of every vector slot by part; the levels are those of the training part."""
    texts = [
        f"SELECT split, '{c}' AS feature, round(sum({c}), 2) AS total FROM parts GROUP BY split"
        for c in LOANS.model_numeric
    ]
    for c in LOANS.categorical:
        levels = f"(SELECT DISTINCT {c} FROM parts WHERE split = 'train')"
        texts.append(
            f"SELECT s.split, '{c}=' || l.{c}, CAST(count(p.{c}) AS DOUBLE)"
            f" FROM (SELECT DISTINCT split FROM parts) s CROSS JOIN {levels} l"
            f" LEFT JOIN parts p ON p.split = s.split AND p.{c} = l.{c} GROUP BY s.split, l.{c}"
        )
        texts.append(
            f"SELECT split, '{c}=__unknown', CAST(count(*) FILTER (WHERE {c} NOT IN {levels}) AS DOUBLE)"
            " FROM parts GROUP BY split"
        )
    return " UNION ALL ".join(texts)


def _indexed():
    ranks = "".join(
        f", idx_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1"
        f" AS DOUBLE) AS {c}_idx FROM prepared GROUP BY {c})"
        for c in LOANS.categorical
    )
    joins = " ".join(f"JOIN idx_{c} USING ({c})" for c in LOANS.categorical)
    return f"{PREPARED}{ranks} SELECT {KEY}, {_list(f'{c}_idx' for c in LOANS.categorical)} FROM prepared {joins}"


def _matrix():
    names = LOANS.matrix_columns
    rows = " AND ".join(f"{c} IS NOT NULL" for c in names)
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name,"
        f" round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM complete"
        for a in names for b in names
    )
    return f"{CLEAN}, complete AS (SELECT * FROM clean WHERE {rows}) {pairs}"


def _relevance():
    columns = [c for c in RAW_COLUMNS if c not in (LABEL, "score", *LOANS.leakage)]
    parts = []
    for c in columns:
        r = (
            f"CASE WHEN stddev_pop({c}) > 0 THEN round(corr({c}, {LABEL}), 4) END"
            if c in PREDICTORS else "CAST(NULL AS DOUBLE)"
        )
        unique = (
            f"coalesce(CAST(count(DISTINCT {c}) AS DOUBLE) / nullif(count({c}), 0), 0e0)"
            if c in CLEAN_TEXT or c in CLEAN_INTEGERS else "0e0"
        )
        parts.append(
            f"SELECT '{c}' AS feature, CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS empty,"
            f" count(DISTINCT {c}) AS d, {unique} AS uniq, {r} AS r FROM clean"
        )
    return (
        f"{CLEAN}, signals AS ({' UNION ALL '.join(parts)}), ranked AS ("
        "SELECT 'most' AS kind, feature, abs(r) AS measure,"
        " CASE WHEN r < 0 THEN 'falls with it' ELSE 'rises with it' END AS reason, 0e0 AS tie"
        " FROM signals WHERE r IS NOT NULL UNION ALL"
        " SELECT 'least', feature, CASE WHEN d <= 1 THEN 1e0 ELSE greatest(empty, uniq) END,"
        " CASE WHEN d <= 1 THEN 'constant' WHEN empty > 0.5 THEN 'mostly missing'"
        " WHEN uniq > 0.5 THEN 'nearly unique' ELSE 'weak signal' END, coalesce(abs(r), 0) FROM signals)"
        " SELECT kind, feature, round(measure, 6) AS measure, reason, CAST(position AS INTEGER)"
        " AS position FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY measure DESC,"
        " tie, feature) AS position FROM ranked) WHERE position <= 7"
    )


def _recommended():
    rows = [
        f"SELECT {i} AS position, '{c}' AS feature, 'numeric' AS kind,"
        f" round(corr({c}, {LABEL}), 4) AS correlation FROM clean"
        for i, c in enumerate(LOANS.recommended, 1)
    ]
    rows += [
        f"SELECT {len(LOANS.recommended) + i}, '{c}', 'categorical', CAST(NULL AS DOUBLE)"
        for i, c in enumerate(LOANS.recommended_categorical, 1)
    ]
    return f"{CLEAN} {' UNION ALL '.join(rows)}"


def _summary():
    ends = []
    for g in ("grade", "term", "verification_status"):
        for end, way in (("highest", "DESC"), ("lowest", "ASC")):
            ends.append(
                f"SELECT * FROM (SELECT '{end}_rate_{g}' AS metric, CAST({g} AS VARCHAR) AS name,"
                f" round(rate, 6) AS value FROM (SELECT {g}, {RATE} FROM clean GROUP BY {g})"
                f" ORDER BY rate {way}, {g} {way} LIMIT 1)"
            )
    return (
        f"{CLEAN}, nulls AS ({_null_profile('raw_loans')})"
        f", corrs AS ({_correlations('clean', SCORED_PREDICTORS)})"
        " SELECT 'rows_raw' AS metric, CAST(NULL AS VARCHAR) AS name,"
        " CAST(count(*) AS DOUBLE) AS value FROM raw_loans"
        f" UNION ALL SELECT 'positives', NULL, CAST(count(*) AS DOUBLE) FROM raw_loans WHERE {LABEL} = 1"
        f" UNION ALL SELECT 'positive_share', NULL, round(CAST(count(*) FILTER (WHERE {LABEL} = 1)"
        f" AS DOUBLE) / count({LABEL}), 6) FROM raw_loans"
        " UNION ALL SELECT 'rows_clean', NULL, CAST(count(*) AS DOUBLE) FROM clean"
        " UNION ALL SELECT 'share_retained', NULL, round(CAST(count(*) AS DOUBLE)"
        " / (SELECT count(*) FROM raw_loans), 6) FROM clean"
        " UNION ALL SELECT * FROM (SELECT 'sparsest_column', \"column\", round(null_share, 6)"
        " FROM nulls ORDER BY null_count DESC, \"column\" LIMIT 5)"
        " UNION ALL SELECT * FROM (SELECT 'strongest_signal', feature, correlation FROM corrs"
        " ORDER BY abs(correlation) DESC, feature LIMIT 1)"
        f" UNION ALL {' UNION ALL '.join(ends)}"
    )


def _model_summary():
    metrics = ("auc_roc", "auc_pr", "precision", "recall", "f1", "threshold")
    sides = " UNION ALL ".join(
        f"SELECT '{m}_{side}', model, round({m}, 6) FROM {side}"
        for side in ("plain", "tuned") for m in metrics
    )
    features = ", ".join(LOANS.features)
    engineered = ", ".join(LOANS.engineered)
    return (
        f"{PAIRS}{PLAIN}{TUNED}, balance AS (SELECT split, count(*) AS n_rows,"
        f" CAST(count(*) FILTER (WHERE {LABEL} = 1) AS DOUBLE) / count(*) AS rate FROM scored"
        f" WHERE {LABEL} IN (0, 1) GROUP BY split)"
        " SELECT 'rows' AS metric, split AS name, CAST(n_rows AS DOUBLE) AS value FROM balance"
        " UNION ALL SELECT 'positive_share', split, round(rate, 6) FROM balance"
        f" UNION ALL SELECT 'features', '{features}', {len(LOANS.features)}e0"
        f" UNION ALL SELECT 'engineered', '{engineered}', {len(LOANS.engineered)}e0"
        f" UNION ALL {sides}"
        " UNION ALL SELECT * FROM (SELECT 'best_by_f1', model, round(f1, 6) FROM tuned"
        " ORDER BY f1 DESC, model LIMIT 1)"
        " UNION ALL SELECT * FROM (SELECT 'best_by_auc_roc', model, round(auc_roc, 6) FROM plain"
        " ORDER BY auc_roc DESC, model LIMIT 1)"
    )


def _stats():
    rows = []
    for c in LOANS.summary:
        v = f"TRY_CAST({c} AS DOUBLE)"
        rows.append(
            f"SELECT '{c}' AS feature, count({v}) AS n, round(avg({v}), 6) AS mean,"
            f" round(stddev_samp({v}), 6) AS stddev, round(min({v}), 6) AS min,"
            f" round(max({v}), 6) AS max FROM raw_loans"
        )
    return f"{RAW} {' UNION ALL '.join(rows)}"


def _funnel():
    complete = " AND ".join(f"{c} IS NOT NULL" for c in LOANS.core)
    return (
        f"{DEDUPED}, typed AS (SELECT * REPLACE ({_replace(PARSED)}) FROM deduped"
        f" WHERE {LABEL} IS NOT NULL), steps AS ("
        f"SELECT 0 AS position, 'raw' AS stage, count(*) AS n_rows, {len(RAW_COLUMNS)} AS n_columns FROM raw_loans"
        f" UNION ALL SELECT 1, 'unique_key', count(*), {len(RAW_COLUMNS)} FROM deduped"
        f" UNION ALL SELECT 2, 'labelled', count(*), {len(RAW_COLUMNS)} FROM typed"
        f" UNION ALL SELECT 3, 'core_complete', count(*), {len(RAW_COLUMNS) - 1} FROM typed WHERE {complete})"
        " SELECT *, CAST(n_rows AS DOUBLE) / (SELECT n_rows FROM steps WHERE position = 0) AS share FROM steps"
    )


SURVIVOR_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ["member_id", *RAW_COLUMNS])
DEDUPED = (
    f"{RAW}, deduped AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER"
    f" (PARTITION BY {KEY} ORDER BY {SURVIVOR_ORDER}) AS rn FROM raw_loans) WHERE rn = 1)"
)
DUPLICATES = f"SELECT {KEY}, count(*) AS n FROM raw_loans GROUP BY {KEY} HAVING count(*) > 1"
SPLIT = (
    f"{RAW}, parts AS (SELECT {KEY}, {LABEL}, {SPLIT_CASE} AS split FROM raw_loans"
    f" WHERE {LABEL} IN (0, 1)), train AS (SELECT * FROM parts WHERE split = 'train')"
)
NEGATIVES, POSITIVES = (f"count(*) FILTER (WHERE {LABEL} = {v})" for v in (0, 1))


MARKED = (
    f"{PREPARED}, marked AS MATERIALIZED (SELECT *, {SPLIT_CASE} AS split FROM prepared WHERE {LABEL} IN (0, 1))"
    ", train AS (SELECT * FROM marked WHERE split = 'train'), rest AS (SELECT * FROM marked WHERE split <> 'train')"
)


def _linear():
    """Weights of numerics as columns of one row, of levels as rows of one table per category."""
    numbers = ", ".join(
        f"avg({c}) FILTER (WHERE {LABEL} = 1) AS a_{c}, avg({c}) FILTER (WHERE {LABEL} = 0) AS b_{c}, var_pop({c}) AS v_{c}"
        for c in LOANS.model_numeric
    )
    weights = ", ".join(f"CASE WHEN v_{c} > 0 THEN (a_{c} - b_{c}) / v_{c} ELSE 0e0 END AS w_{c}" for c in LOANS.model_numeric)
    middle = " + ".join(f"w_{c} * (a_{c} + b_{c}) / 2" for c in LOANS.model_numeric)
    levels = "".join(
        f", l_{c} AS (SELECT {c}, ln((count(*) FILTER (WHERE {LABEL} = 1) + 5e-1) / (count(*) FILTER (WHERE {LABEL} = 0) + 5e-1))"
        f" AS o_{c} FROM train GROUP BY {c})" for c in LOANS.categorical
    )
    margin = " + ".join([f"-({middle})", *(f"{c} * w_{c}" for c in LOANS.model_numeric), *(f"coalesce(o_{c}, 0e0)" for c in LOANS.categorical)])
    joins = " ".join(f"LEFT JOIN l_{c} USING ({c})" for c in LOANS.categorical)
    return (
        f"{MARKED}, n AS (SELECT {numbers} FROM train), w AS MATERIALIZED (SELECT *, {weights} FROM n){levels}"
        f" SELECT {KEY}, split, round(1e0 / (1 + exp(-({margin}))), 6) AS score FROM rest {joins}, w"
    )


def _forest():
    """Nodes by rule: every numeric splits at its mean, both halves at the mean of the next numeric."""
    names = LOANS.model_numeric
    means = ", ".join(f"round(avg({c}), 3) AS m_{c}" for c in names)

    def sides(source, keep):
        return " UNION ALL ".join(
            f"SELECT {keep}, {i} AS tree, CASE WHEN {c} <= m_{c} THEN 1 ELSE 2 END AS half,"
            f" CASE WHEN {d} <= m_{d} THEN 1 ELSE 2 END AS quarter FROM {source}, means"
            for i, (c, d) in enumerate(zip(names, [*names[1:], names[0]]))
        )

    gini = "(2e0 * sum(pos) * (sum(n) - sum(pos)) / sum(n))"
    return (
        f"{MARKED}, means AS MATERIALIZED (SELECT {means} FROM train), sides AS ({sides('train', LABEL)})"
        f", cells AS MATERIALIZED (SELECT tree, half, quarter, count(*) AS n, count(*) FILTER (WHERE {LABEL} = 1) AS pos"
        " FROM sides GROUP BY ALL)"
        f", whole AS (SELECT tree, 0 AS half, sum(n) AS n, {gini} AS impure FROM cells GROUP BY tree)"
        f", halves AS (SELECT tree, half, sum(n) AS n, {gini} AS impure FROM cells GROUP BY tree, half)"
        f", quarters AS (SELECT tree, half, quarter, {gini} AS impure FROM cells GROUP BY tree, half, quarter)"
    ), sides


def statements() -> dict[str, str]:
    """SQL by query name."""
    numeric = [c for c in RAW_COLUMNS if c not in RAW_TEXT]
    rated = "accuracy, precision_weighted, recall_weighted"
    return {
        "table_shape": f"{RAW} SELECT count(*) AS n_rows, {len(RAW_COLUMNS)} AS n_columns,"
        f" {len(numeric)} AS n_numeric, '{', '.join(RAW_COLUMNS[:5])}' AS leading_columns FROM raw_loans",
        "require_columns": f"{RAW} SELECT {_list([KEY, *LOANS.raw_columns])} FROM raw_loans",
        "csv_round_trip": f"{CLEAN} SELECT * FROM clean",
        "parquet_round_trip": f"{CLEAN} SELECT * FROM clean",
        "result_round_trip": f"{CLEAN} SELECT grade, {RATE} FROM clean GROUP BY grade",
        "prediction_sample": f"{RAW} SELECT {LABEL}, prediction_tuned, score FROM (SELECT {KEY}, {LABEL},"
        f" {_predicted('score')} AS prediction_tuned, score FROM raw_loans ORDER BY {KEY},"
        f" {LABEL} NULLS FIRST, prediction_tuned, score LIMIT 1000)",
        "select_present": f"{RAW} SELECT {_list([KEY, *LOANS.summary])} FROM raw_loans",
        "drop_columns": f"{RAW} SELECT * EXCLUDE (description) FROM raw_loans",
        "columns_by_type": f"{RAW} SELECT"
        f" {_list(c for c in numeric if c not in LOANS.non_predictors)} FROM raw_loans",
        "exclude_leakage": f"{RAW} SELECT * EXCLUDE (total_pymnt) FROM raw_loans",
        "drop_null_target": f"{RAW} SELECT {KEY}, {LABEL}, grade FROM raw_loans WHERE {LABEL} IS NOT NULL",
        "require_complete": f"{CLEAN} SELECT {KEY}, {_list(LOANS.core)}, {LABEL} FROM clean",
        "drop_sparse": f"{RAW} SELECT * EXCLUDE (sparse_col) FROM raw_loans WHERE {LABEL} IS NOT NULL",
        "cast_lenient": f"{RAW} SELECT {KEY}, {_columns(CASTS)} FROM raw_loans",
        "parse_term": f"{TYPED} SELECT {KEY}, term FROM typed",
        "parse_percent": f"{TYPED} SELECT {KEY}, revol_util FROM typed",
        "clean_table": f"{CLEAN} SELECT * EXCLUDE (sparse_col) FROM clean",
        "fill_unknown": f"{RAW} SELECT {KEY}, {_known()} FROM raw_loans",
        "fill_unknown_null_only": f"{RAW} SELECT {KEY}, {_known(False)} FROM raw_loans",
        "map_ordinal": f"{RAW} SELECT {KEY}, grade, {GRADE.format('grade')} AS grade_ord FROM raw_loans",
        "map_ordinal_normalized": f"{RAW} SELECT {KEY}, ' ' || lower(grade) AS grade_text,"
        f" {GRADE.format('grade')} AS grade_ord FROM raw_loans",
        "safe_ratio": f"{CLEAN} SELECT {KEY}, {_columns(RATIOS)} FROM clean",
        "safe_ratio_capped": f"{CLEAN} SELECT {KEY}, {_columns(_capped(NONZERO))} FROM clean",
        "interaction": f"{CLEAN}, ranked AS (SELECT *, {GRADE.format('grade')} AS grade_ord FROM clean)"
        f" SELECT {KEY}, {_columns(PRODUCTS)} FROM ranked",
        "clip_upper": f"{CLEAN} SELECT {KEY},"
        f" {_columns({n: r for n, r in _capped(RATIOS).items() if n in LOANS.ratio_caps})} FROM clean",
        "prepare_features": f"{PREPARED} SELECT * FROM prepared",
        "prepare_features_capped": f"{_prepared(_capped(NONZERO), False, 'upper(trim(grade))')}"
        f" SELECT * FROM prepared",
        "label_names": f"{RAW} SELECT {KEY}, {LABEL}, CASE {LABEL} WHEN 0 THEN 'No default'"
        f" WHEN 1 THEN 'Default' ELSE CAST({LABEL} AS VARCHAR) END AS class_name FROM raw_loans",
        "sample_by_key": f"{RAW} SELECT {KEY}, {LABEL} FROM raw_loans WHERE {_hash('|sample')} < 0.05",
        "duplicate_report": f"{RAW}, d AS (SELECT DISTINCT * FROM raw_loans), t AS (SELECT count(*) AS rows_raw,"
        f" count(DISTINCT {KEY}) AS distinct_key, count(DISTINCT {LOANS.entity}) AS distinct_entity,"
        f" (SELECT count(*) FROM d) AS whole FROM raw_loans) SELECT rows_raw, distinct_key, distinct_entity,"
        " rows_raw - distinct_key AS duplicate_keys, rows_raw - whole AS identical_rows,"
        " rows_raw - distinct_key AS rows_removed, distinct_key AS rows_after FROM t",
        "duplicate_keys": f"{RAW} {DUPLICATES}",
        "first_rows": f"{RAW} {DUPLICATES} ORDER BY {KEY} LIMIT 5",
        "distinct_rows": f"{RAW} SELECT DISTINCT * FROM raw_loans",
        "dedup_by_key": f"{DEDUPED} SELECT * FROM deduped",
        "row_count": f"{RAW} SELECT count(*) AS n_rows FROM raw_loans",
        "distinct_count": f"{RAW} " + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM raw_loans"
            for c in (KEY, LOANS.entity, "emp_length")
        ),
        "summary_stats": _stats(),
        "null_profile": f"{RAW} {_null_profile('raw_loans')}",
        "null_profile_labelled": f"{RAW}, labelled AS (SELECT * FROM raw_loans WHERE {LABEL} IS NOT NULL)"
        f" {_null_profile('labelled')}",
        "top_nulls": f"{RAW} SELECT * FROM ({_null_profile('raw_loans')})"
        ' ORDER BY null_count DESC, "column" LIMIT 25',
        "class_balance": f"{RAW} SELECT {LABEL}, CASE {LABEL} WHEN 0 THEN 'No default' ELSE 'Default' END"
        f" AS class_name, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count({LABEL}) FROM raw_loans)"
        f" AS share FROM raw_loans WHERE {LABEL} IS NOT NULL GROUP BY {LABEL}",
        "rate_by_grade": f"{CLEAN} SELECT grade, {RATE} FROM clean GROUP BY grade ORDER BY grade",
        "rate_by_term": f"{CLEAN} SELECT term, {RATE} FROM clean GROUP BY term ORDER BY term",
        "rates_for_columns": f"{CLEAN} {RATES_LONG}",
        "top_categories": f"{CLEAN} SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY \"column\""
        f" ORDER BY rate DESC, category NULLS FIRST) AS INTEGER) AS position FROM ({RATES_LONG}))"
        " WHERE position <= 10",
        "rate_ranking": f"{CLEAN} SELECT verification_status, {RATE} FROM clean"
        " GROUP BY verification_status ORDER BY rate",
        "constant_columns": f"{CLEAN}, d AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", stddev_samp({c}) AS stddev FROM clean" for c in PREDICTORS
        ) + ") SELECT * FROM d WHERE stddev IS NULL OR stddev = 0",
        "corr_target_pairwise": f"{CLEAN} {_correlations('target', SCORED_PREDICTORS)}",
        "corr_target_zero": f"{CLEAN} {_correlations('target', SCORED_PREDICTORS, zero=True)}",
        "skipped_correlations": f"{TYPED}, t AS (SELECT *, CAST(NULL AS DOUBLE) AS unused FROM typed WHERE {LABEL} IS NOT NULL)"
        ", facts AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count({c}) AS pairs, min(CAST({c} AS DOUBLE)) AS low, max(CAST({c} AS DOUBLE)) AS high,"
            f" min(CASE WHEN {c} IS NOT NULL THEN {LABEL} END) AS least, max(CASE WHEN {c} IS NOT NULL THEN {LABEL} END) AS most FROM t"
            for c in [*(c for c in CLEAN_NUMBERS if c != "score"), "unused"]
        ) + ") SELECT feature, CASE WHEN pairs = 0 THEN 'no values' WHEN low = high THEN 'constant' ELSE 'one class' END AS reason"
        " FROM facts WHERE pairs = 0 OR low = high OR least = most ORDER BY feature",
        "corr_matrix": _matrix(),
        "histogram_by_label": _histogram(False),
        "histogram_per_class": _histogram(True),
        "cleaning_funnel": _funnel(),
        "feature_relevance": _relevance(),
        "recommended_features": _recommended(),
        "stage_summary": _summary(),
        "order_by": f"{CLEAN} SELECT sub_grade, {RATE} FROM clean GROUP BY sub_grade"
        " ORDER BY rate DESC, sub_grade",
        "order_by_abs": f"{CLEAN} SELECT * FROM ({_correlations('target', SCORED_PREDICTORS)})"
        " ORDER BY abs(correlation) DESC, feature",
        "top_k": f"{RAW} SELECT {KEY}, grade, annual_inc, loan_amnt FROM raw_loans"
        f" ORDER BY loan_amnt DESC, {KEY}, grade, annual_inc LIMIT 25",
        "union_by_name": f"{RAW} SELECT {KEY}, {LABEL}, grade FROM raw_loans WHERE {LABEL} IN (0, 1)",
        "argmax_row": f"{CLEAN} SELECT sub_grade, {RATE} FROM clean GROUP BY sub_grade"
        " ORDER BY rate DESC, sub_grade LIMIT 1",
        "stratified_split": f"{SPLIT} SELECT * FROM parts",
        "split_balance": f"{SPLIT} SELECT split, count(*) AS n_rows, {POSITIVES} AS positives,"
        f" CAST({POSITIVES} AS DOUBLE) / count(*) AS rate FROM parts GROUP BY split",
        "class_weights": f"{SPLIT}, w AS (SELECT CAST({NEGATIVES} AS DOUBLE) / {POSITIVES} AS ratio"
        f" FROM train) SELECT {KEY}, {LABEL}, CASE WHEN {LABEL} = 1 THEN (SELECT ratio FROM w)"
        " ELSE 1e0 END AS weight FROM train",
        "class_counts": f"{RAW} SELECT {NEGATIVES} AS negatives, {POSITIVES} AS positives,"
        f" CAST({NEGATIVES} AS DOUBLE) / {POSITIVES} AS ratio,"
        f" CAST({POSITIVES} AS DOUBLE) / ({NEGATIVES} + {POSITIVES}) AS rate FROM raw_loans",
        "undersample": f"{SPLIT}, c AS (SELECT {NEGATIVES} AS n0, {POSITIVES} AS n1 FROM train)"
        ", f AS (SELECT CASE WHEN floor(n1 * 3e0) >= n0 THEN 1e0 ELSE floor(n1 * 3e0) / n0 END"
        f" AS fraction FROM c) SELECT {KEY}, {LABEL} FROM train, f WHERE {LABEL} = 1"
        f" OR {_hash('|undersample')} < fraction",
        "index_categories": _indexed(),
        "index_by_table": _indexed(),
        "category_codes": f"{PREPARED} " + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n,"
            f" row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS code FROM prepared GROUP BY {c}"
            for c in LOANS.categorical
        ),
        "one_hot": f"{PREPARED} {_slots('prepared', [])}",
        "assemble": f"{TYPED}, complete AS (SELECT * FROM typed WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in LOANS.numeric)
        + f") {_slots('complete', LOANS.numeric, unknown_slots=False)}",
        "scale": f"{PREPARED.replace(', prepared AS (', ', prepared AS MATERIALIZED (')}, m AS (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LOANS.numeric)
        + f" FROM prepared) SELECT {KEY}, "
        + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0e0 AS {c}" for c in LOANS.numeric)
        + " FROM prepared, m",
        "score_linear": _linear(),
        "score_forest": f"{_forest()[0]}, numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS row FROM rest)"
        f", walked AS ({_forest()[1]('numbered', f'row, {KEY}, split')})"
        f" SELECT {KEY}, split, round(avg(CAST(pos AS DOUBLE) / n), 6) AS score FROM walked"
        f" JOIN cells USING (tree, half, quarter) GROUP BY row, {KEY}, split",
        "forest_importance": f"{_forest()[0]}, gains AS (SELECT w.tree, w.tree AS slot, w.impure - sum(h.impure) AS gain"
        " FROM whole w JOIN halves h USING (tree) GROUP BY w.tree, w.impure"
        f" UNION ALL SELECT tree, (tree + 1) % {len(LOANS.model_numeric)}, sum(lost) FROM (SELECT h.tree, h.half,"
        " h.impure - sum(q.impure) AS lost FROM halves h JOIN quarters q USING (tree, half) GROUP BY h.tree, h.half, h.impure)"
        " GROUP BY tree), shares AS (SELECT slot, sum(gain / whole) AS part FROM gains"
        " JOIN (SELECT tree, sum(gain) AS whole FROM gains GROUP BY tree) USING (tree) WHERE whole > 0 GROUP BY slot)"
        " SELECT CAST(slot AS INTEGER) AS slot, round(part / (SELECT sum(part) FROM shares), 6) AS importance FROM shares",
        "feature_pipeline": f"{PREPARED}, train AS (SELECT * FROM prepared WHERE {_hash()} < 0.64)"
        f" {_slots('train', LOANS.model_numeric)}",
        "feature_pipeline_parts": f"{PREPARED}, parts AS (SELECT *, {SPLIT_CASE} AS split FROM prepared"
        f" WHERE {LABEL} IN (0, 1)) {_slots_by_part()}",
        "apply_threshold": f"{PAIRS}{_sweep('scored', 'score')} SELECT {KEY}, score,"
        f" {_predicted('score', '(SELECT threshold FROM best)')} AS prediction_tuned FROM scored",
        "confusion_counts": f"{HALF} SELECT * FROM counts",
        "class_metrics": f"{HALF}, c AS (SELECT *, {CLASS} FROM counts) SELECT *, {F1} FROM c",
        "overall_metrics": f"{HALF} SELECT *, {_columns(OVERALL, 6)} FROM counts",
        "auc_roc": f"{PAIRS}{_curve('scored', 'score')} SELECT round({ROC_AREA}, 6) AS auc_roc FROM run",
        "auc_pr": f"{PAIRS}{_curve('scored', 'score')} SELECT round({PR_AREA}, 6) AS auc_pr FROM run",
        "average_precision": f"{PAIRS}{_curve('scored', 'score')}"
        f" SELECT round({AVERAGE_PRECISION}, 6) AS average_precision FROM run",
        "roc_points": f"{PAIRS}{_curve('scored', 'score')} SELECT score, CAST(fp AS DOUBLE) / n AS fpr,"
        " CAST(tp AS DOUBLE) / p AS tpr FROM run UNION ALL SELECT NULL, 0e0, 0e0",
        "pr_points": f"{PAIRS}{_curve('scored', 'score')} SELECT score,"
        " CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,"
        " CAST(tp AS DOUBLE) / p AS recall FROM run UNION ALL SELECT NULL, 1e0, 0e0",
        "threshold_sweep": f"{PAIRS}{_sweep('scored', 'score')} SELECT * FROM sweep",
        "best_threshold": f"{PAIRS}{_sweep('scored', 'score')} SELECT * FROM best",
        "evaluate": f"{PAIRS}{PLAIN} SELECT * FROM plain",
        "evaluate_tuned": f"{PAIRS}{TUNED} SELECT * FROM tuned",
        "threshold_table": f"{PAIRS}{TUNED} SELECT model, threshold, validation_f1, f1 AS test_f1 FROM tuned",
        "confusion_table": f"{PAIRS}{PLAIN} SELECT model, tp, tn, fp, fn FROM plain",
        "confusion_table_tuned": f"{PAIRS}{TUNED} SELECT model, threshold, tp, tn, fp, fn FROM tuned",
        "compare_scores": f"{PAIRS}{PLAIN}{TUNED} SELECT model, 'plain' AS cut, {ROUNDED_METRICS} FROM plain"
        f" UNION ALL SELECT model, 'tuned', {ROUNDED_METRICS} FROM tuned",
        "select_best": f"{PAIRS}{_evaluations(True, 'val', 'chosen')} SELECT * FROM chosen"
        " ORDER BY f1 DESC, model LIMIT 1",
        "model_summary": _model_summary(),
    }
