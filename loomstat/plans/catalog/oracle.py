"""SQL text for the iterative fits: the definitions as recursive queries over the same rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from loomstat.operators.sampling import BUCKETS


@dataclass(frozen=True)
class Steps:
    """Gradient descent as a recursive query, one row per step."""

    rows: str
    label: str
    features: Sequence[str]
    gradient: str
    updater: str
    step_size: float
    reg_param: float
    iterations: int
    tolerance: float = 0.0
    batch_key: str | None = None
    batch_share: float = 1.0
    digits: int = 6
    edge: float = 0.0

    def _gradient(self) -> tuple[list[str], str]:
        xs = list(self.features)
        margin = " + ".join(f"{x} * w{j}" for j, x in enumerate(xs))
        if self.gradient == "least_squares":
            error = f"({margin} - {self.label})"
            return [f"{error} * {x}" for x in xs], f"{error} * {error} / 2"
        if self.gradient == "hinge":
            side = f"(2 * {self.label} - 1)"
            room = f"(1 - {side} * ({margin}))"
            parts = [f"CASE WHEN {room} > 0 THEN -{side} * {x} ELSE 0 END" for x in xs]
            return parts, f"greatest({room}, 0)"
        error, edge = f"({margin} - {self.label})", f"{self.edge}::DOUBLE"  # huber
        parts = [f"greatest(-{edge}, least({edge}, {error})) * {x}" for x in xs]
        loss = f"CASE WHEN abs({error}) <= {edge} THEN {error} * {error} / 2 ELSE {edge} * (abs({error}) - {edge} / 2) END"
        return parts, loss

    def _update(self, j: int, step: str) -> str:
        plain = f"(w{j} - {step} * g{j})"
        if self.updater == "NONE":
            return plain
        if self.updater == "L1":
            return f"sign({plain}) * greatest(0, abs({plain}) - {step} * {self.reg_param}::DOUBLE)"
        return f"(w{j} * (1 - {step} * {self.reg_param}::DOUBLE) - {step} * g{j})"

    def _penalty(self) -> str:
        ws = [f"w{j}" for j in range(len(self.features))]
        if self.updater == "L1":
            return f"{self.reg_param}::DOUBLE * (" + " + ".join(f"abs({w})" for w in ws) + ")"
        if self.updater == "L2":
            return f"0.5::DOUBLE * {self.reg_param}::DOUBLE * (" + " + ".join(f"{w} * {w}" for w in ws) + ")"
        return "0"

    def recursion(self) -> str:
        """A WITH clause that ends in ``w(i, w0.., loss, done)``."""
        d = range(len(self.features))
        parts, loss = self._gradient()
        step = f"({self.step_size}::DOUBLE / sqrt(i + 1))"
        where = ""
        if self.batch_key:
            limit = round(self.batch_share * BUCKETS)
            where = (
                f" WHERE concat('0x', substr(md5(concat({self.batch_key}::VARCHAR, ':', (i + 1)::VARCHAR)), 1, 13))::BIGINT"
                f" < {limit}"
            )
        ws = ", ".join(f"w{j}" for j in d)
        gs = ", ".join(f"avg({p}) AS g{j}" for j, p in enumerate(parts))
        ns = ", ".join(f"{self._update(j, step)} AS n{j}" for j in d)
        moved = " + ".join(f"(n{j} - w{j}) ** 2" for j in d)
        size = " + ".join(f"n{j} ** 2" for j in d)
        return f"""
    WITH RECURSIVE f AS MATERIALIZED ({self.rows}),
    w(i, {ws}, loss, done) AS (
        SELECT 0, {", ".join("0.0::DOUBLE" for _ in d)}, NULL::DOUBLE, false
        UNION ALL
        SELECT i + 1, {", ".join(f"n{j}" for j in d)}, l,
               i >= 1 AND sqrt({moved}) < {self.tolerance}::DOUBLE * greatest(sqrt({size}), 1)
        FROM (SELECT i, {ws}, {ns}, l + {self._penalty()} AS l
              FROM (SELECT i, {ws}, {", ".join(f"g{j}" for j in d)}, l
                    FROM w, LATERAL (SELECT {gs}, avg({loss}) AS l FROM f{where}) t
                    WHERE i < {self.iterations} AND NOT done) a) b)
    """

    def weights(self) -> str:
        cells = " UNION ALL ".join(
            f"SELECT 'w{j}' AS term, round(w{j}, {self.digits}) + 0.0::DOUBLE AS weight FROM last"
            for j in range(len(self.features))
        )
        return f"{self.recursion()}, last AS (SELECT * FROM w ORDER BY i DESC LIMIT 1) {cells}"

    def losses(self) -> str:
        return f"{self.recursion()} SELECT i AS iteration, round(loss, 6) AS loss FROM w WHERE i > 0"


def _logistic_steps(
    rows: str, label: str, features: Sequence[str], reg_type: str, reg_param: float, iterations: int
) -> str:
    """The optimum by proximal steps of fixed length; features in [0, 1] keep length 2 safe."""
    d = range(len(features))
    margin = " + ".join(f"{x} * w{j}" for j, x in enumerate(features))
    gs = ", ".join(f"avg((1 / (1 + exp(-({margin}))) - {label}) * {x}) AS g{j}" for j, x in enumerate(features))
    ws, step, reg = ", ".join(f"w{j}" for j in d), "2.0::DOUBLE", f"{reg_param}::DOUBLE"
    if reg_type == "L1":
        moved = [f"sign(w{j} - {step} * g{j}) * greatest(0, abs(w{j} - {step} * g{j}) - {step} * {reg})" for j in d]
    else:
        moved = [f"w{j} - {step} * (g{j} + {reg} * w{j})" for j in d]
    return f"""
    WITH RECURSIVE f AS MATERIALIZED ({rows}),
    w(i, {ws}) AS (
        SELECT 0, {", ".join("0.0::DOUBLE" for _ in d)}
        UNION ALL
        SELECT i + 1, {", ".join(moved)}
        FROM (SELECT i, {ws}, {", ".join(f"g{j}" for j in d)}
              FROM w, LATERAL (SELECT {gs} FROM f) t WHERE i < {iterations}) a),
    last AS (SELECT * FROM w WHERE i = {iterations})
    """


def logistic_sql(
    rows: str, label: str, features: Sequence[str], reg_type: str, reg_param: float, iterations: int
) -> str:
    cells = " UNION ALL ".join(
        f"SELECT 'w{j}' AS term, round(w{j}, 4) + 0.0::DOUBLE AS weight FROM last" for j in range(len(features))
    )
    return f"{_logistic_steps(rows, label, features, reg_type, reg_param, iterations)} {cells}"


def _bayes_model(rows: str, features: Sequence[str]) -> str:
    total = " + ".join(f"sum({f})" for f in features)
    logs = ", ".join(
        f"ln((sum({f}) + 1) / ({total} + {len(features)})) AS log_{f}" for f in features
    )
    return f"""
        SELECT label, ln((count(*) + 1) / (sum(count(*)) OVER () + count(*) OVER ())) AS log_prior, {logs}
        FROM ({rows}) GROUP BY label"""


def naive_bayes_model_sql(rows: str, features: Sequence[str]) -> str:
    logs = ", ".join(f"round({c}, 6) AS {c}" for c in ["log_prior", *[f"log_{f}" for f in features]])
    return f"SELECT label, {logs} FROM ({_bayes_model(rows, features)})"


def _bayes_scores(rows: str, training: str, features: Sequence[str]) -> str:
    score = " + ".join(["log_prior", *[f"r.{f} * log_{f}" for f in features]])
    return f"""
        SELECT doc_id, label, min(option) AS prediction FROM (
            SELECT doc_id, label, option, score, max(score) OVER (PARTITION BY doc_id) AS best FROM (
                SELECT r.doc_id, r.label, m.label AS option, {score} AS score
                FROM ({rows}) r, ({_bayes_model(training, features)}) m))
        WHERE score >= best - abs(best) * 1e-9 GROUP BY doc_id, label"""


def naive_bayes_predict_sql(rows: str, features: Sequence[str]) -> str:
    return _bayes_scores(rows, rows, features)


def naive_bayes_accuracy_sql(rows: str, features: Sequence[str], train: str) -> str:
    training = f"SELECT * FROM ({rows}) WHERE {train}"
    return f"""
    SELECT count(*) FILTER ({train}) AS n_training, count(*) FILTER (NOT {train}) AS n_test,
           round(avg((prediction = label)::INT) FILTER (NOT {train}), 6) AS accuracy
    FROM ({_bayes_scores(rows, training, features)})"""


def _impurity(kind: str, n: str, s: str, s2: str) -> str:
    p = f"({s} / {n})"
    if kind == "Variance":
        return f"({s2} / {n} - {p} * {p})"
    if kind == "Gini":
        return f"(1 - {p} * {p} - (1 - {p}) * (1 - {p}))"
    bits = [f"CASE WHEN {q} > 0 THEN -{q} * log2({q}) ELSE 0 END" for q in (p, f"(1 - {p})")]
    return f"({bits[0]} + {bits[1]})"


def _candidates(kind: str, bins: str) -> str:
    """Over bins (node, x, nx, n, s, s2): every split of every node with its gain."""
    whole = _impurity(kind, "tn", "ts", "ts2")
    low = _impurity(kind, "ln", "ls", "ls2")
    high = _impurity(kind, "(tn - ln)", "(ts - ls)", "(ts2 - ls2)")
    return f"""
        SELECT node, (x + nx) / 2 AS threshold, {whole} AS impurity,
               {whole} - ({low} * ln + {high} * (tn - ln)) / tn AS gain
        FROM (SELECT node, x, nx,
                     sum(n) OVER a AS ln, sum(s) OVER a AS ls, sum(s2) OVER a AS ls2,
                     sum(n) OVER b AS tn, sum(s) OVER b AS ts, sum(s2) OVER b AS ts2
              FROM ({bins})
              WINDOW a AS (PARTITION BY node ORDER BY x), b AS (PARTITION BY node))
        WHERE ln < tn"""


def _bins(rows: str, label: str) -> str:
    return f"""
        SELECT x, lead(x) OVER (ORDER BY x) AS nx, n, s, s2 FROM (
            SELECT x, count(*)::DOUBLE AS n, sum({label})::DOUBLE AS s, sum({label} * {label})::DOUBLE AS s2
            FROM ({rows}) GROUP BY x)"""


def root_split_sql(rows: str, label: str, impurity: str) -> str:
    bins = f"SELECT 1 AS node, * FROM ({_bins(rows, label)})"
    return f"""
    SELECT threshold, round(gain, 6) AS gain FROM ({_candidates(impurity, bins)})
    ORDER BY round(gain / nullif(impurity, 0), 12) DESC, threshold LIMIT 1"""


def tree_sql(rows: str, label: str, impurity: str, depth: int) -> str:
    """A whole tree on one feature: each level splits every node at its best threshold."""
    levels = [f"WITH t0 AS MATERIALIZED (SELECT 1 AS node, * FROM ({_bins(rows, label)}))"]
    for k in range(depth):
        best = f"""
            SELECT node, threshold FROM (
                SELECT node, threshold,
                       row_number() OVER (PARTITION BY node ORDER BY round(gain / nullif(impurity, 0), 12) DESC, threshold) AS r
                FROM ({_candidates(impurity, f"SELECT * FROM t{k}")}) WHERE gain > 0)
            WHERE r = 1"""
        levels.append(f"""
    t{k + 1} AS MATERIALIZED (
        SELECT 2 * t.node + CASE WHEN x > threshold THEN 1 ELSE 0 END AS node, x, nx, n, s, s2
        FROM t{k} t LEFT JOIN ({best}) b ON b.node = t.node)""")
    mean = "sum(s) OVER (PARTITION BY node) / sum(n) OVER (PARTITION BY node)"
    value = f"round({mean}, 6)" if impurity == "Variance" else f"CASE WHEN {mean} > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return (
        ",".join(levels)
        + f" SELECT p_partkey, prediction FROM ({rows}) r JOIN (SELECT x, {value} AS prediction FROM t{depth}) l"
        " ON l.x = r.x"
    )


def tree_holdout_sql(
    rows: str, label: str, features: Sequence[str], impurity: str, depth: int, train: str, measure: str
) -> str:
    """A tree over several features of few values, fit on the training keys; counts and a test measure."""
    xs = ", ".join(features)
    sums = f"count(*)::DOUBLE AS n, sum({label})::DOUBLE AS s, sum({label} * {label})::DOUBLE AS s2"
    parts = [f"""WITH f AS MATERIALIZED (SELECT *, {train} AS training FROM ({rows})),
    t0 AS MATERIALIZED (SELECT 1 AS node, {xs}, {sums} FROM f WHERE training GROUP BY {xs})"""]
    for j, x in enumerate(features):
        parts.append(f"""m{j} AS MATERIALIZED (
            SELECT x, lead(x) OVER (ORDER BY x) AS nx FROM (SELECT DISTINCT {x} AS x FROM f WHERE training))""")
    for k in range(depth):
        options = []
        for j, x in enumerate(features):
            bins = f"""SELECT node, x, nx, sum(n) AS n, sum(s) AS s, sum(s2) AS s2
                       FROM t{k} JOIN m{j} ON m{j}.x = {x} GROUP BY node, x, nx"""
            options.append(f"SELECT {j} AS j, node, threshold, impurity, gain FROM ({_candidates(impurity, bins)})")
        side = "CASE j " + " ".join(f"WHEN {j} THEN {x} > threshold" for j, x in enumerate(features)) + " END"
        parts.append(f"""b{k} AS MATERIALIZED (SELECT node, j, threshold FROM (
            SELECT *, row_number() OVER (PARTITION BY node
                ORDER BY round(gain / nullif(impurity, 0), 12) DESC, j, threshold) AS r
            FROM ({" UNION ALL ".join(options)}) WHERE gain > 1e-12 * impurity) WHERE r = 1)""")
        parts.append(f"""t{k + 1} AS MATERIALIZED (
            SELECT 2 * t.node + CASE WHEN {side} THEN 1 ELSE 0 END AS node, {xs}, n, s, s2
            FROM t{k} t LEFT JOIN b{k} b ON b.node = t.node)""")
    leaf = "SELECT node, sum(s) / sum(n) AS value FROM t" + str(depth) + " GROUP BY node"
    place = "1"
    walk = f"SELECT *, {place} AS node FROM f"
    for k in range(depth):
        side = "CASE j " + " ".join(f"WHEN {j} THEN {x} > threshold" for j, x in enumerate(features)) + " END"
        walk = f"""SELECT w.* EXCLUDE (node), 2 * w.node + CASE WHEN {side} THEN 1 ELSE 0 END AS node
                   FROM ({walk}) w LEFT JOIN b{k} b ON b.node = w.node"""
    if measure == "mse":
        test = f"avg((value - {label}) ** 2) FILTER (NOT training)"
    else:
        test = f"avg(((value > 0.5)::INT = {label})::INT) FILTER (NOT training)"
    parts.append(f"leaf AS ({leaf}), walked AS ({walk})")
    return ",\n    ".join(parts) + f"""
    SELECT count(*) FILTER (training) AS n_training, count(*) FILTER (NOT training) AS n_test,
           round({test}, 6) AS {measure} FROM walked JOIN leaf USING (node)"""


def lloyd_sql(points: str, start: Sequence[Sequence[float]], iterations: int) -> str:
    """Moves of given centers over distinct points with a count; near ties go to the lower number."""
    k = range(len(start))
    names = ", ".join(f"x{c}, y{c}" for c in k)
    distances = [f"((p.x - x{c}) ** 2 + (p.y - y{c}) ** 2)" for c in k]
    least = f"least({', '.join(distances)}) * (1 + 1e-9)"
    nearest = "CASE " + " ".join(f"WHEN {d} <= {least} THEN {c}" for c, d in enumerate(distances)) + " END"
    sums = ", ".join(
        f"sum(n * x) FILTER (a = {c}) / sum(n) FILTER (a = {c}) AS mx{c},"
        f" sum(n * y) FILTER (a = {c}) / sum(n) FILTER (a = {c}) AS my{c}"
        for c in k
    )
    moved = ", ".join(f"coalesce(mx{c}, x{c}), coalesce(my{c}, y{c})" for c in k)
    first = ", ".join(f"{x}::DOUBLE, {y}::DOUBLE" for x, y in start)
    cells = " UNION ALL ".join(
        f"SELECT {c} AS cluster, round(x{c}, 6) AS x, round(y{c}, 6) AS y FROM w WHERE i = {iterations}" for c in k
    )
    return f"""
    WITH RECURSIVE p AS MATERIALIZED (SELECT x, y, count(*)::DOUBLE AS n FROM ({points}) GROUP BY x, y),
    w(i, {names}) AS (
        SELECT 0, {first}
        UNION ALL
        SELECT i + 1, {moved}
        FROM (SELECT * FROM w, LATERAL (
                  SELECT {sums} FROM (SELECT p.x, p.y, p.n, {nearest} AS a FROM p) q) t
              WHERE i < {iterations}) m)
    {cells}
    """


def _last(steps: Steps) -> str:
    return f"{steps.recursion()}, last AS (SELECT * FROM w ORDER BY i DESC LIMIT 1)"


def holdout_regression_sql(rows: str, label: str, features: Sequence[str], train: str) -> str:
    """The sales job with its defaults: 100 steps of 0.001, L2 with 0.1, early stop at 0.001."""
    steps = Steps(
        f"SELECT * FROM ({rows}) WHERE {train}", label, features, "least_squares", "L2", 0.001, 0.1, 100, 0.001
    )
    margin = " + ".join(f"{x} * w{j}" for j, x in enumerate(features))
    text = ", ".join(f"any_value(w{j})" for j in range(len(features)))
    formats = ",".join("%.4f" for _ in features)
    return f"""{_last(steps)}
    SELECT count(*) FILTER ({train}) AS n_training, count(*) FILTER (NOT {train}) AS n_test,
           printf('{formats}', {text}) AS weights,
           round(sqrt(avg(({margin} - {label}) ** 2) FILTER (NOT {train})), 6) AS rmse
    FROM ({rows}) r, last"""


def holdout_svm_sql(
    rows: str, features: Sequence[str], train: str, iterations: int, step_size: float, reg_param: float
) -> str:
    """Rows (k, y, features): fit on the training keys, accuracy and both areas on the others."""
    steps = Steps(
        f"SELECT * FROM ({rows}) WHERE {train}", "y", features, "hinge", "L1", step_size, reg_param, iterations, 0.001
    )
    return f"""{_last(steps)}, {_held_out(rows, features, train)}
    SELECT (SELECT count(*) FROM scored WHERE training) AS n_training,
           (SELECT count(*) FROM scored WHERE NOT training) AS n_test,
           (SELECT round(100 * avg(((score > 0)::INT = y)::INT), 6) FROM scored WHERE NOT training) AS accuracy,
           round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr FROM areas"""


def holdout_logistic_sql(rows: str, features: Sequence[str], train: str, reg_param: float, iterations: int) -> str:
    """Rows (k, y, features): L2 fit on the training keys, both areas on the others."""
    training = f"SELECT * FROM ({rows}) WHERE {train}"
    return f"""{_logistic_steps(training, "y", features, "L2", reg_param, iterations)},
    {_held_out(rows, features, train)}
    SELECT (SELECT count(*) FROM scored WHERE training) AS n_training,
           (SELECT count(*) FROM scored WHERE NOT training) AS n_test,
           round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr FROM areas"""


def _held_out(rows: str, features: Sequence[str], train: str) -> str:
    """Scores by the weights in ``last``, and both areas over the rows outside the training keys."""
    margin = " + ".join(f"{x} * w{j}" for j, x in enumerate(features))
    return f"""
    scored AS (SELECT {train} AS training, y, round({margin}, 12) AS score FROM ({rows}) r, last),
    pts AS (SELECT score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
            FROM scored WHERE NOT training GROUP BY score),
    cum AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
            FROM pts WINDOW o AS (ORDER BY score DESC)),
    areas AS (SELECT sum(neg * (tp - pos / 2)) / any_value(np * nn) AS auc_roc,
                     sum(pos * (tp / (tp + fp)
                         + coalesce((tp - pos) / nullif(tp + fp - pos - neg, 0), tp / (tp + fp))) / 2)
                       / any_value(np) AS auc_pr FROM cum)"""


def _half_step_sql(pairs: str, fixed: str, by: str, other: str, reg_param: float, implicit: bool) -> str:
    """Two factors per key, by Cramer's rule."""
    weight, right, counted = ("abs(r)", "CASE WHEN r > 0 THEN 1 + abs(r) ELSE 0 END", "count(*) FILTER (r > 0)") if implicit else ("1", "r", "count(*)")
    base = {c: f"(SELECT sum({e}) FROM {fixed})" if implicit else "0" for c, e in (("a", "f0*f0"), ("b", "f0*f1"), ("c", "f1*f1"))}
    return f"""
        SELECT id, (c*p - b*q) / (a*c - b*b) AS f0, (a*q - b*p) / (a*c - b*b) AS f1
        FROM (SELECT {by} AS id, {base['a']} + sum({weight}*f0*f0) + {reg_param} * {counted} AS a,
                     {base['b']} + sum({weight}*f0*f1) AS b,
                     {base['c']} + sum({weight}*f1*f1) + {reg_param} * {counted} AS c,
                     sum(f0 * ({right})) AS p, sum(f1 * ({right})) AS q
              FROM {pairs} JOIN {fixed} ON {fixed}.id = {other} GROUP BY {by})"""


def als_sql(pairs_sql: str, half_steps: int, reg_param: float, implicit: bool = False) -> str:
    """CTEs ``pairs(u, p, r)`` and the factors of rank two: ``users0``, ``items0``, then ``items1``, ``users1``
    and so on, one table per half-step."""
    start = lambda side, seed: ", ".join(
        f"concat('0x', substr(md5(concat({seed}, ':', id, ':', {j})), 1, 13))::BIGINT / ({BUCKETS} * sqrt(2.0::DOUBLE)) AS f{j}"
        for j in range(2)
    )
    ctes = [f"pairs AS ({pairs_sql})"]
    for name, side, seed in (("users0", "u", 0), ("items0", "p", 1)):
        ctes.append(f"{name} AS MATERIALIZED (SELECT id, {start(side, seed)} FROM (SELECT DISTINCT {side} AS id FROM pairs))")
    last = {"users": "users0", "items": "items0"}
    for k in range(half_steps):
        to, of, by, other = ("items", "users", "p", "u") if k % 2 == 0 else ("users", "items", "u", "p")
        name = f"{to}{k // 2 + 1}"
        ctes.append(f"{name} AS MATERIALIZED ({_half_step_sql('pairs', last[of], by, other, reg_param, implicit)})")
        last[to] = name
    return "WITH " + ",\n".join(ctes)


def _sums_impurity(kind: str, sums: Sequence[str]) -> tuple[str, str]:
    """Rows and impurity from sums per class, or from count, sum and square sum."""
    if kind == "Variance":
        n, s, s2 = sums
        return n, f"({s2} / nullif({n}, 0) - ({s} / nullif({n}, 0)) ** 2)"
    n = f"({' + '.join(sums)})"
    shares = [f"({s} / nullif({n}, 0))" for s in sums]
    if kind == "Gini":
        return n, f"(1 - {' - '.join(f'{p} ** 2' for p in shares)})"
    return n, "-(" + " + ".join(f"CASE WHEN {p} > 0 THEN {p} * log2({p}) ELSE 0 END" for p in shares) + ")"


def tree_nodes_sql(rows: str, stats: Sequence[str], value: str, features: Sequence[str], impurity: str, depth: int) -> str:
    """The splits of a tree over several features of few values, with any number of classes.

    ``stats`` are SQL sums per class (or count, sum, square sum); ``value`` gives a node's prediction from
    the columns s0, s1, ... of its sums.
    """
    xs, m = ", ".join(features), range(len(stats))
    names = ", ".join(f"s{i}" for i in m)
    parts = [f"""f AS MATERIALIZED (SELECT * FROM ({rows})),
    t0 AS MATERIALIZED (SELECT 1 AS node, {xs}, {", ".join(f"{e} AS s{i}" for i, e in enumerate(stats))} FROM f GROUP BY {xs})"""]
    for j, x in enumerate(features):
        parts.append(f"""m{j} AS MATERIALIZED (
            SELECT x, (x + lead(x) OVER (ORDER BY x)) / 2 AS threshold FROM (SELECT DISTINCT {x} AS x FROM f))""")
    total, left = [f"t{i}" for i in m], [f"l{i}" for i in m]
    (n, whole), (low_n, low) = _sums_impurity(impurity, total), _sums_impurity(impurity, left)
    high_n, high = _sums_impurity(impurity, [f"(t{i} - l{i})" for i in m])
    gain = f"({whole}) - (coalesce({low}, 0) * {low_n} + coalesce({high}, 0) * {high_n}) / {n}"
    for k in range(depth):
        options = []
        for j, x in enumerate(features):
            running = ", ".join(
                f"sum(s{i}) OVER (PARTITION BY node ORDER BY threshold NULLS LAST) AS l{i}, sum(s{i}) OVER (PARTITION BY node) AS t{i}" for i in m
            )
            sums = ", ".join(f"sum(s{i}) AS s{i}" for i in m)
            options.append(f"""SELECT {j} AS j, node, threshold, {gain} AS gain, {whole} AS before FROM (
                SELECT node, threshold, {running}
                FROM (SELECT node, threshold, {sums} FROM t{k} JOIN m{j} ON m{j}.x = {x} GROUP BY node, threshold))
                WHERE threshold IS NOT NULL AND {low_n} < {n}""")
        side = "CASE j " + " ".join(f"WHEN {j} THEN {x} > threshold" for j, x in enumerate(features)) + " END"
        parts.append(f"""b{k} AS MATERIALIZED (SELECT node, j, threshold, gain FROM (
            SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain / nullif(before, 0), 12) DESC, j, threshold) AS r
            FROM ({" UNION ALL ".join(options)}) WHERE gain > 1e-12 * before) WHERE r = 1)""")
        parts.append(f"""t{k + 1} AS MATERIALIZED (
            SELECT 2 * t.node + CASE WHEN {side} THEN 1 ELSE 0 END AS node, {xs}, {names}
            FROM t{k} t JOIN b{k} b ON b.node = t.node)""")
    every = " UNION ALL ".join(
        f"SELECT node, {', '.join(f'sum(s{i}) AS s{i}' for i in m)} FROM t{k} GROUP BY node" for k in range(depth + 1)
    )
    splits = " UNION ALL ".join(f"SELECT * FROM b{k}" for k in range(depth)) or "SELECT 0 AS node, 0 AS j, 0 AS threshold, 0 AS gain"
    cells, size = ", ".join(f"'{x}'" for x in features), _sums_impurity(impurity, [f"s{i}" for i in m])[0]
    return "WITH " + ",\n    ".join(parts) + f"""
    SELECT e.node::BIGINT AS node, [{cells}][j + 1] AS feature, round(threshold, 6) + 0.0::DOUBLE AS threshold,
           round(gain, 6) + 0.0::DOUBLE AS gain, {size}::DOUBLE AS n, round({value}, 6) + 0.0::DOUBLE AS prediction
    FROM ({every}) e LEFT JOIN ({splits}) b ON b.node = e.node"""


def seeds_sql(points: str, k: int, rounds: int, per_round: float) -> str:
    """Oversampled seeding of points (k, x, y): the same draws, weights and choices."""

    def draw(r: int) -> str:
        return f"concat('0x', substr(md5(concat('0:', {r}, ':', k)), 1, 13))::BIGINT"

    away = "(p.x - c.x) ** 2 + (p.y - c.y) ** 2"
    parts = [f"p AS MATERIALIZED ({points})", f"c0 AS MATERIALIZED (SELECT * FROM p ORDER BY {draw(0)}, k LIMIT 1)"]
    for r in range(1, rounds + 1):
        parts.append(f"d{r} AS MATERIALIZED (SELECT p.k, p.x, p.y, min({away}) AS d FROM p, c{r - 1} c GROUP BY ALL)")
        parts.append(f"""c{r} AS MATERIALIZED (SELECT * FROM c{r - 1} UNION SELECT k, x, y FROM d{r}
            WHERE {draw(r)} / {BUCKETS}::DOUBLE < d * ({per_round} / (SELECT sum(d) FROM d{r})))""")
    parts.append(f"""n AS (SELECT p.k, c.k AS c, row_number() OVER (PARTITION BY p.k ORDER BY {away}, c.k) AS r
        FROM p, c{rounds} c)""")
    parts.append(f"w AS MATERIALIZED (SELECT c.*, count(*) AS w FROM c{rounds} c JOIN n ON n.c = c.k AND r = 1 GROUP BY ALL)")
    parts.append("s1 AS MATERIALIZED (SELECT 0 AS i, k, x, y FROM w ORDER BY w DESC, k LIMIT 1)")
    for i in range(2, k + 1):
        parts.append(f"""s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL (
            SELECT {i - 1}, p.k, p.x, p.y FROM w p, s{i - 1} c GROUP BY p.k, p.x, p.y, p.w ORDER BY p.w * min({away}) DESC, p.k LIMIT 1))""")
    return "WITH " + ", ".join(parts) + f" SELECT i AS cluster, round(x, 6) + 0.0::DOUBLE AS x, round(y, 6) + 0.0::DOUBLE AS y FROM s{k}"
