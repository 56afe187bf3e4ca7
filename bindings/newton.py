"""SQL text that fits an L2 logistic regression by Newton steps: an independent check of the model.

One model per value of ``g``. Every level gets a 0/1 column; that of the reference level is all
zeros, so its coefficient stays 0 under the penalty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


class NewtonSql:
    def __init__(
        self,
        rows: str,
        numeric: Sequence[str],
        levels: Mapping[str, Sequence[str]],
        c: float = 1.0,
        steps: int = 8,
    ):
        self.numeric = list(numeric)
        self.levels = {k: list(v) for k, v in levels.items()}
        self.dummies = [(k, v) for k, vs in self.levels.items() for v in vs]
        self.width = 1 + len(self.numeric) + len(self.dummies)
        self.penalty = [0.0] + [1.0 / c] * (self.width - 1)
        self.parts = [f"t AS MATERIALIZED ({rows})"]
        self._learn()
        self._start()
        for k in range(steps):
            self._step(k)
        self.beta = f"b{steps}"
        self.last = steps

    def _learn(self) -> None:
        scales = "".join(
            f", avg({n}) AS mu{i}, CASE WHEN stddev_pop({n}) = 0 THEN 1 ELSE stddev_pop({n}) END AS sd{i}"
            for i, n in enumerate(self.numeric)
        )
        self.parts.append(f"sc AS MATERIALIZED (SELECT g, count(*) AS n, sum(y) AS positives{scales} FROM t GROUP BY g)")
        for j, column in enumerate(self.levels):
            self.parts.append(
                f"rf{j} AS MATERIALIZED (SELECT g, lvl AS ref{j} FROM (SELECT g, {column} AS lvl, row_number() OVER "
                f"(PARTITION BY g ORDER BY count(*) DESC, {column}) AS place FROM t WHERE {column} IS NOT NULL GROUP BY g, {column}) WHERE place = 1)"
            )
        joins = " ".join(f"JOIN rf{j} USING (g)" for j in range(len(self.levels)))
        self.parts.append(f"facts AS MATERIALIZED (SELECT * FROM sc {joins})")

    def x(self) -> list[str]:
        """The model columns over a row that is joined with ``facts``."""
        columns = ["1.0"]
        columns += [f"(CAST({n} AS DOUBLE) - mu{i}) / sd{i}" for i, n in enumerate(self.numeric)]
        at = {c: j for j, c in enumerate(self.levels)}
        columns += [
            f"(CASE WHEN {c} = '{v}' AND ref{at[c]} <> '{v}' THEN 1.0 ELSE 0.0 END)" for c, v in self.dummies
        ]
        return columns

    def probability(self) -> str:
        """P(positive) over a row joined with ``facts`` and the last coefficients."""
        eta = " + ".join(f"b{i} * {x}" for i, x in enumerate(self.x()))
        return f"1.0 / (1.0 + exp(-({eta})))"

    def _start(self) -> None:
        xs = ", ".join(f"{x} AS x{i}" for i, x in enumerate(self.x()))
        self.parts.append(f"x AS MATERIALIZED (SELECT g, y, {xs}, count(*) AS m FROM t JOIN facts USING (g) GROUP BY ALL)")
        zeros = ", ".join(f"CAST(0 AS DOUBLE) AS b{i}" for i in range(self.width))
        self.parts.append(f"b0 AS MATERIALIZED (SELECT g, {zeros} FROM sc)")

    def weighted(self, beta: str) -> str:
        eta = " + ".join(f"b{i} * x{i}" for i in range(self.width))
        return f"(SELECT *, 1.0 / (1.0 + exp(-({eta}))) AS p FROM x JOIN {beta} USING (g))"

    def gram(self, beta: str, i: int, j: int) -> str:
        i, j = min(i, j), max(i, j)
        return f"sum(m * p * (1 - p) * x{i} * x{j})"

    def _solve(self, name: str, sides: int) -> str:
        """Gauss-Jordan elimination of columns a<i>_<j>; j from width on are right-hand sides."""
        w, total = self.width, self.width + sides
        for k in range(w):
            columns = []
            for i in range(w):
                for j in range(total):
                    if i == k:
                        columns.append(f"a{i}_{j} / a{k}_{k} AS a{i}_{j}")
                    else:
                        columns.append(f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}")
            kept = ", ".join([f"b{i}" for i in range(w)])
            self.parts.append(f"{name}_{k} AS MATERIALIZED (SELECT g, {kept}, {', '.join(columns)} FROM {name if k == 0 else f'{name}_{k - 1}'})")
        return f"{name}_{w - 1}"

    def _step(self, k: int) -> None:
        w = self.width
        cells = []
        for i in range(w):
            for j in range(w):
                cells.append(f"{self.gram(f'b{k}', i, j)} + {self.penalty[i] if i == j else 0.0} AS a{i}_{j}")
            cells.append(f"sum(m * (y - p) * x{i}) - {self.penalty[i]} * b{i} AS a{i}_{w}")
        bs = ", ".join(f"b{i}" for i in range(w))
        self.parts.append(f"h{k} AS MATERIALIZED (SELECT g, {bs}, {', '.join(cells)} FROM {self.weighted(f'b{k}')} GROUP BY g, {bs})")
        solved = self._solve(f"h{k}", 1)
        new = ", ".join(f"b{i} + a{i}_{w} AS b{i}" for i in range(w))
        self.parts.append(f"b{k + 1} AS MATERIALIZED (SELECT g, {new} FROM {solved})")

    def invert(self) -> str:
        """Adds the inverse of the penalised precision at the last step; returns the relation's name."""
        w = self.width
        cells = []
        for i in range(w):
            for j in range(w):
                cells.append(f"{self.gram(self.beta, i, j)} + {self.penalty[i] if i == j else 0.0} AS a{i}_{j}")
            cells += [f"CAST({int(i == j)} AS DOUBLE) AS a{i}_{w + j}" for j in range(w)]
        bs = ", ".join(f"b{i}" for i in range(w))
        self.parts.append(f"inv AS MATERIALIZED (SELECT g, {bs}, {', '.join(cells)} FROM {self.weighted(self.beta)} GROUP BY g, {bs})")
        return self._solve("inv", w)

    def with_clause(self) -> str:
        return "WITH " + ",\n".join(self.parts)


class LevelNewtonSql:
    """The same for a number ``x`` and one column ``level`` of many values, over rows ``(y, x, level)``.

    The levels' block of the Hessian is diagonal, so it is eliminated level by level, which leaves two equations.
    """

    def __init__(self, rows: str, c: float = 1.0, steps: int = 10):
        self.c = c
        self.parts = [
            f"t AS MATERIALIZED ({rows})",
            "ref AS (SELECT level AS ref FROM (SELECT level, count(*) AS n FROM t WHERE level IS NOT NULL GROUP BY 1) ORDER BY n DESC, level LIMIT 1)",
            "z AS MATERIALIZED (SELECT y, (x - mu) / sd AS z, CASE WHEN level <> ref THEN level END AS level FROM t, ref, "
            "(SELECT avg(x) AS mu, stddev_pop(x) AS sd FROM t))",
            "d0 AS MATERIALIZED (SELECT CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1)",
            "l0 AS MATERIALIZED (SELECT DISTINCT level, CAST(0 AS DOUBLE) AS b FROM z WHERE level IS NOT NULL)",
        ]
        for k in range(steps):
            self._sums(k)
            self.parts += [
                f"d{k + 1} AS MATERIALIZED (SELECT b0 + (s11 * r0 - s01 * r1) / det AS b0, b1 + (s00 * r1 - s01 * r0) / det AS b1 FROM s{k})",
                f"l{k + 1} AS MATERIALIZED (SELECT level, b + (g - a0 * (n.b0 - o.b0) - a1 * (n.b1 - o.b1)) / d AS b FROM e{k}, d{k + 1} n, d{k} o)",
            ]
        self.last = steps
        self._sums(steps)

    def probability(self, k: int) -> str:
        return f"(SELECT z.*, 1 / (1 + exp(-(b0 + b1 * z + coalesce(b, 0)))) AS p FROM z LEFT JOIN l{k} USING (level), d{k})"

    def _sums(self, k: int) -> None:
        """The diagonal of the levels and their coupling, and the two equations that are left."""
        c = self.c
        self.parts += [
            f"p{k} AS MATERIALIZED {self.probability(k)}",
            f"e{k} AS MATERIALIZED (SELECT level, any_value(b) AS b, sum(y - p) - any_value(b) / {c} AS g, sum(p * (1 - p)) + 1 / {c} AS d, "
            f"sum(p * (1 - p)) AS a0, sum(p * (1 - p) * z) AS a1 FROM p{k} JOIN l{k} USING (level) GROUP BY level)",
            f"""s{k} AS MATERIALIZED (SELECT b0, b1, s00, s01, s11, r0, r1, s00 * s11 - s01 * s01 AS det FROM (
              SELECT b0, b1, w - a00 AS s00, wz - a01 AS s01, wzz + 1 / {c} - a11 AS s11, g0 - h0 AS r0, g1 - b1 / {c} - h1 AS r1 FROM d{k},
                (SELECT sum(p * (1 - p)) AS w, sum(p * (1 - p) * z) AS wz, sum(p * (1 - p) * z * z) AS wzz, sum(y - p) AS g0, sum((y - p) * z) AS g1 FROM p{k}),
                (SELECT sum(a0 * a0 / d) AS a00, sum(a0 * a1 / d) AS a01, sum(a1 * a1 / d) AS a11, sum(a0 * g / d) AS h0, sum(a1 * g / d) AS h1 FROM e{k})))""",
        ]

    def coefficients(self) -> str:
        """``level, coef, se``; the level of the number is ''."""
        k = self.last
        u = "(a0 * a0 * s11 - 2 * a0 * a1 * s01 + a1 * a1 * s00) / (d * d * det)"
        return f"(SELECT '' AS level, b1 AS coef, sqrt(s00 / det) AS se FROM s{k} UNION ALL SELECT level, b, sqrt(1 / d + {u}) FROM e{k}, s{k})"

    def with_clause(self) -> str:
        return "WITH " + ",\n".join(self.parts)
