"""The registered queries again, as SQL over the same tables.

Written from what the queries mean, not from how they run: links are not added
up first, positions come from one global window, fits are unrolled.
"""

from __future__ import annotations

from tidemill.plans.queries import (
    CLASSES,
    CROP_PAD,
    DIM,
    MEANS,
    RUN,
    SEED,
    STDS,
    TOTAL_BATCH_SIZE,
    WORLD,
)

SUPPLY = """
  SELECT 'P' || l_partkey AS source, 'S' || l_suppkey AS target FROM lineitem
  UNION ALL
  SELECT 'S' || l_suppkey, 'P' || l_partkey FROM lineitem
"""
ACTIVITY = """
  SELECT 'U' || user_id AS source, event_type AS target FROM events
  UNION ALL
  SELECT event_type, 'U' || user_id FROM events
"""
PAGES = """
  SELECT url AS source, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target FROM pages
"""


def _round(value: str, digits: int) -> str:
    return f"round({value}, {digits}) + 0.0"  # no negative zero


def _rank_ctes(edges: str, iters: int, weight: str = "raw", missing: str = "NULL") -> str:
    if weight == "raw":
        links = "links AS (SELECT source, target, 1.0::DOUBLE AS share FROM edges)"
    else:
        links = """degrees AS (SELECT source, count(*) AS n FROM edges GROUP BY source),
  links AS (SELECT e.source, target, 1.0::DOUBLE / n AS share FROM edges e JOIN degrees d USING (source))"""
    ctes = [
        f"edges AS ({edges})",
        links,
        "r0 AS (SELECT DISTINCT source, 1.0::DOUBLE AS rank FROM edges)",
    ]
    for k in range(1, iters + 1):
        ctes.append(
            f"""r{k} AS (
    SELECT target AS source, sum(coalesce(rank, {missing}) * share) * 0.85 + 0.15 AS rank
    FROM links LEFT JOIN r{k - 1} USING (source) GROUP BY target)"""
        )
    return ",\n  ".join(ctes)


def _ranks(edges: str, iters: int, digits: int, **options: str) -> str:
    return f"""WITH {_rank_ctes(edges, iters, **options)}
SELECT source, {_round('rank', digits)} AS rank FROM r{iters}"""


def _order(seed_and_epoch: str) -> str:
    return f"""
  SELECT vec_id, embedding, label,
         row_number() OVER (ORDER BY md5('{seed_and_epoch}:' || vec_id), vec_id) - 1 AS pos,
         count(*) OVER () AS total
  FROM embeddings"""


def _polynomial(epoch: int, k: int, x: str) -> str:
    """Round ``k`` of the keyed order of an epoch, at ``x``: four coefficients, one prime."""
    digits = f"md5('{SEED}:{epoch}:{k}')"
    c = [f"('0x' || substr({digits}, {7 * i + 1}, 7))::BIGINT" for i in range(4)]
    return f"(((({c[0]} * {x} + {c[1]}) % 2147483647) * {x} + {c[2]}) % 2147483647 * {x} + {c[3]}) % 2147483647"


def _permuted(epoch: int) -> str:
    """Where the rows, numbered by one keyed hash, go: twice three rounds on two halves,
    and again for those that come out too high."""
    rounds = "SELECT vec_id, step, n, a, b, y // b AS h, y % b AS l FROM walk WHERE step = 0 OR y >= n"
    for k in range(6):
        if k % 2:
            halves = f"h, (l + {_polynomial(epoch, k, 'h')}) % b AS l"
        else:
            halves = f"(h + {_polynomial(epoch, k, 'l')}) % a AS h, l"
        rounds = f"SELECT vec_id, step, n, a, b, {halves} FROM ({rounds})"
    return f"""
  SELECT {epoch} AS epoch, vec_id, y AS pos FROM (
    WITH RECURSIVE numbered AS (
      SELECT vec_id, row_number() OVER (ORDER BY md5('{SEED}:' || vec_id), vec_id) - 1 AS y,
             count(*) OVER () AS n FROM embeddings),
    sized AS (
      SELECT *, ceil(sqrt(n))::BIGINT AS a,
             ((n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT) AS b FROM numbered),
    walk AS (
      SELECT vec_id, 0 AS step, n, a, b, y FROM sized
      UNION ALL
      SELECT vec_id, step + 1, n, a, b, h * b + l AS y FROM ({rounds}))
    SELECT vec_id, y FROM walk WHERE step > 0 AND y < n)"""


def _shards(world: int) -> str:
    return f"""
  SELECT vec_id, embedding, label, slot % {world} AS rank, slot // {world} AS pos_in_rank
  FROM (
    SELECT *, unnest(range(pos, ((total + {world} - 1) // {world}) * {world}, total)) AS slot
    FROM ({_order(f'{SEED}:0')}))"""


def _batches(where: str = "") -> str:
    size = TOTAL_BATCH_SIZE // WORLD
    return f"""
SELECT vec_id, rank::INTEGER AS rank, pos_in_rank // {size} AS batch_idx,
       pos_in_rank % {size} AS pos_in_batch
FROM ({_shards(WORLD)}) {where}"""


def _number(start: int, length: int, epoch: int = 0) -> str:
    return f"('0x' || substr(md5('{SEED}:{epoch}:' || vec_id), {start}, {length}))::BIGINT"


def _by_channel(values: list[float]) -> str:
    cases = " ".join(f"WHEN {c} THEN {v!r}::DOUBLE" for c, v in enumerate(values))
    return f"(CASE i // 16 {cases} END)"


def _cell(down: str, right: str) -> str:
    """Value of the 4x4x4 image at cell i, moved; zero outside."""
    y, x = f"((i % 16) // 4 + {down})", f"(i % 4 + {right})"
    return f"""(CASE WHEN {y} BETWEEN 0 AND 3 AND {x} BETWEEN 0 AND 3
      THEN embedding[((i // 16) * 16 + {y} * 4 + {x} + 1)::INTEGER]::DOUBLE ELSE 0.0::DOUBLE END)"""


def _moves(epoch: int = 0) -> str:
    return f"""
SELECT *, {_number(1, 8, epoch)} % {2 * CROP_PAD + 1} - {CROP_PAD} AS down,
       {_number(9, 8, epoch)} % {2 * CROP_PAD + 1} - {CROP_PAD} AS rightward,
       {_number(17, 1, epoch)} % 2 = 0 AS mirrored, unnest(range(64)) AS i FROM embeddings"""


def _pixels(value: str) -> str:
    return f"""
SELECT vec_id, i::INTEGER AS pos, {_round(value, 9)} AS value FROM ({_moves()})"""


_MIRRORED = "(CASE WHEN mirrored THEN 3 - 2 * (i % 4) ELSE 0 END)"
_STANDARD = f"({{}} - {_by_channel(MEANS)}) / {_by_channel(STDS)}"
_AUGMENTED = _STANDARD.format(f"{_cell('down', f'{_MIRRORED} + rightward')} / 255.0")


def _softmax_ctes(name: str, weights: str, x: str = "x") -> str:
    """CTE ``name``: rows (id, class, score, p, loss) of the cells in ``x``."""
    return f"""{name}_z AS (
    SELECT id, class, label, sum(value * weight) AS score
    FROM {weights} JOIN {x} USING (dim) GROUP BY id, class, label),
  {name}_m AS (SELECT id, max(score) AS top FROM {name}_z GROUP BY id),
  {name}_e AS (
    SELECT id, any_value(top) AS top, sum(exp(score - top)) AS total
    FROM {name}_z JOIN {name}_m USING (id) GROUP BY id),
  {name} AS (
    SELECT id, class, score, exp(score - top) / total AS p, class = label AS hit,
           top + ln(total) - score AS loss
    FROM {name}_z JOIN {name}_e USING (id))"""


def _cells(source: str, bias: bool = False) -> str:
    """CTEs: ``rows`` with an id for each row, and ``x``, its features by dim."""
    one = f" UNION ALL SELECT id, label, {DIM} AS dim, 1.0::DOUBLE FROM rows" if bias else ""
    return f"""rows AS MATERIALIZED ({source}),
  x AS MATERIALIZED (
    SELECT id, label, unnest(range({DIM})) AS dim, unnest(embedding)::DOUBLE AS value FROM rows{one})"""


def _grid(width: int) -> str:
    return f"""
    SELECT class, unnest(range({width})) AS dim FROM (SELECT unnest(range({CLASSES})) AS class)"""


def _gradient(step: str, weights: str, where: str, x: str = "x") -> str:
    """CTEs for one batch: ``{step}_g`` (class, dim, g), ``{step}_loss``."""
    return f"""{_softmax_ctes(f'{step}_p', weights, x)},
  {step}_r AS (
    SELECT rank, class, dim, avg((p - hit::INTEGER) * value) AS g
    FROM {step}_p JOIN rows USING (id) JOIN {x} USING (id) WHERE {where} GROUP BY rank, class, dim),
  {step}_g AS (SELECT class, dim, avg(g) AS g FROM {step}_r GROUP BY class, dim),
  {step}_loss AS (
    SELECT avg(loss) AS loss FROM (
      SELECT rank, avg(loss) AS loss FROM {step}_p JOIN rows USING (id)
      WHERE hit AND {where} GROUP BY rank))"""


def _fit_ctes(
    source: str, steps: int, batches: int = 1, bias: bool = False, cells: list[str] | None = None
) -> str:
    """``cells``: for each step a CTE of what the features are then, if not ``x``."""
    ctes = [
        _cells(source, bias),
        f"""w0 AS (
    SELECT class, dim, 0.0::DOUBLE AS weight, 0.0::DOUBLE AS velocity FROM ({_grid(DIM + bias)}))""",
    ]
    for t in range(steps):
        x = "x"
        if cells:
            x = f"x{t}"
            ctes.append(f"{x} AS MATERIALIZED ({cells[t]})")
        ctes.append(_gradient(f"s{t}", f"w{t}", f"batch_idx = {t % batches}", x))
        ctes.append(
            f"""w{t + 1} AS MATERIALIZED (
    SELECT class, dim, weight - 0.1 * v AS weight, v AS velocity
    FROM (SELECT class, dim, weight, 0.9 * velocity + g + 0.0001 * weight AS v
          FROM w{t} JOIN s{t}_g USING (class, dim)))"""
        )
    return ",\n  ".join(ctes)


_WHOLE = "SELECT vec_id AS id, embedding, label, 0 AS rank, 0 AS batch_idx FROM embeddings"
_HALVES = f"""
  SELECT row_number() OVER () AS id, embedding, label, rank,
         pos_in_rank // ((max(pos_in_rank) OVER () + 2) // 2) AS batch_idx
  FROM ({_shards(WORLD)})"""


def _weights(source: str, steps: int, **options) -> str:
    return f"""WITH {_fit_ctes(source, steps, **options)}
SELECT class, dim, {_round('weight', 9)} AS value FROM w{steps}"""


_FIT = _weights(_WHOLE, 3)
_LOSSES = f"""WITH {_fit_ctes(_WHOLE, 3)}
SELECT 0 AS epoch, 1::BIGINT AS iteration, {_round('loss', 9)} AS loss FROM s0_loss
UNION ALL SELECT 1, 1, {_round('loss', 9)} FROM s1_loss
UNION ALL SELECT 2, 1, {_round('loss', 9)} FROM s2_loss"""
_GRADIENT = f"""WITH {_cells(f'SELECT row_number() OVER () AS id, embedding, label, rank FROM ({_shards(WORLD)})')},
  w AS (SELECT class, dim, 0.0::DOUBLE AS weight FROM ({_grid(DIM)})),
  {_gradient('s', 'w', 'TRUE')}
SELECT class, dim, {_round('g', 9)} AS value FROM s_g"""

_SAMPLE_SCORES = f"""{_cells('SELECT vec_id AS id, embedding, label FROM embeddings')},
  w AS (SELECT class, dim, ((7 * class + 3 * dim) % 11 - 5) / 50.0::DOUBLE AS weight
        FROM ({_grid(DIM)})),
  {_softmax_ctes('s', 'w')},
  best AS (SELECT id, arg_max(class, score) AS predicted FROM s GROUP BY id),
  own AS (SELECT id, loss, class AS label FROM s WHERE hit),
  hits AS (
    SELECT sum((predicted = label)::INTEGER)::BIGINT AS correct, count(*) AS total
    FROM best JOIN own USING (id)),
  batch_losses AS (
    SELECT avg(loss) AS loss FROM (
      SELECT loss, (row_number() OVER (ORDER BY id) - 1) // {TOTAL_BATCH_SIZE} AS batch FROM own)
    GROUP BY batch)"""
_RAW3 = _ranks(SUPPLY, 3, 6)


def _exact_ranks(iters: int) -> str:
    """Raw ranks in decimals, of which no digit is rounded away in so few iterations."""
    ctes = [
        f"edges AS ({SUPPLY})",
        "r0 AS (SELECT DISTINCT source, 1::DECIMAL(28, 12) AS rank FROM edges)",
    ]
    for k in range(1, iters + 1):
        ctes.append(
            f"""r{k} AS (
    SELECT target AS source,
           (sum(rank)::DECIMAL(34, 12) * 0.85::DECIMAL(2, 2) + 0.15::DECIMAL(2, 2))::DECIMAL(28, 12) AS rank
    FROM edges LEFT JOIN r{k - 1} USING (source) GROUP BY target)"""
        )
    return f"WITH {', '.join(ctes)} SELECT source, rank::VARCHAR AS rank FROM r{iters}"


_EVENT_LOG = "SELECT event_id + 1 AS iteration, value FROM events"

ORACLES: dict[str, str] = {
    "edge_parse": SUPPLY,
    "edge_clean": SUPPLY,
    "init_ranks": f"SELECT DISTINCT source, 1.0::DOUBLE AS rank FROM ({SUPPLY})",
    "out_degree": f"SELECT source, count(*) AS n FROM ({SUPPLY}) GROUP BY source",
    "pagerank_step": _ranks(SUPPLY, 1, 6),
    "pagerank_raw": _RAW3,
    "pagerank": _ranks(SUPPLY, 10, 9, weight="out_degree"),
    "pagerank_acyclic": f"""WITH {_rank_ctes(PAGES, 2)}
SELECT 1 AS iteration, source, {_round('rank', 6)} AS rank FROM r1
UNION ALL
SELECT 2, source, {_round('rank', 6)} FROM r2""",
    "pagerank_teleport": _ranks(PAGES, 3, 9, weight="out_degree", missing="0.15"),
    "pagerank_partitioned": _RAW3,
    "pagerank_cached": _RAW3,
    "pagerank_restart": _RAW3,
    "pagerank_exact": _exact_ranks(3),
    "pagerank_skewed": _ranks(ACTIVITY, 3, 9, weight="out_degree"),
    "rank_csv_roundtrip": _ranks(f"{SUPPLY} UNION ALL {PAGES}", 2, 6),
    "csv_sort": """
SELECT event_id::VARCHAR AS event_id, ts::VARCHAR AS ts, user_id::VARCHAR AS user_id, event_type,
       value::VARCHAR AS value, props::VARCHAR AS props,
       row_number() OVER (ORDER BY event_type NULLS FIRST, ts::VARCHAR NULLS FIRST) - 1 AS pos
FROM events""",
    "train_test_split": f"""
SELECT vec_id AS id, label,
       CASE WHEN ('0x' || substr(md5('{SEED}:' || vec_id), 1, 8))::BIGINT % 100 < 20
            THEN 'test' ELSE 'train' END AS split
FROM embeddings""",
    "shard_assign": f"""
SELECT 3 AS world, vec_id, rank::INTEGER AS rank, pos_in_rank FROM ({_shards(3)})
UNION ALL
SELECT 4, vec_id, rank::INTEGER, pos_in_rank FROM ({_shards(4)})""",
    "epoch_shuffle": f"""
SELECT 0 AS epoch, vec_id, pos FROM ({_order(f'{SEED}:0')})
UNION ALL
SELECT 1, vec_id, pos FROM ({_order(f'{SEED}:1')})""",
    "epoch_permutation": f"{_permuted(0)} UNION ALL {_permuted(1)}",
    "minibatch": _batches(),
    "batch_layout": f"""
SELECT vec_id, rank::INTEGER AS rank, pos_in_rank // 8 AS batch_idx, pos_in_rank % 8 AS pos_in_batch
FROM ({_shards(WORLD)}) QUALIFY batch_idx = 0 OR batch_idx = max(batch_idx) OVER ()""",
    "batch_cutoff": _batches(f"WHERE pos_in_rank // {TOTAL_BATCH_SIZE // WORLD} < 1"),
    "channel_standardize": _pixels(_STANDARD.format("embedding[i + 1]::DOUBLE")),
    "random_crop": _pixels(_cell("down", "rightward")),
    "random_flip": _pixels(_cell("0", _MIRRORED)),
    "augment": _pixels(_AUGMENTED),
    "eval_pixels": _pixels(_STANDARD.format("embedding[i + 1]::DOUBLE / 255.0")),
    "softmax_score": f"""WITH {_SAMPLE_SCORES}
SELECT id AS vec_id, class::INTEGER AS class, predicted::INTEGER AS predicted,
       {_round('own.loss', 9)} AS loss, {_round('score', 9)} AS score
FROM s JOIN (SELECT id, loss FROM own) own USING (id) JOIN best USING (id)""",
    "gradient_rank_mean": _GRADIENT,
    "gradient_allreduce": _GRADIENT,
    "sgd_fit": _FIT,
    "sgd_losses": _LOSSES,
    "sgd_minibatch": _weights(_HALVES, 4, batches=2, bias=True),
    "sgd_augmented": _weights(
        _WHOLE,
        2,
        cells=[
            f"SELECT vec_id AS id, label, i AS dim, {_AUGMENTED} AS value FROM ({_moves(epoch)})"
            for epoch in (0, 1)
        ],
    ),
    "fit_log_resume": _LOSSES,
    "checkpoint_resume": _FIT,
    "checkpoint_fallback": _FIT,
    "evaluate": f"""WITH {_SAMPLE_SCORES}
SELECT {_round('any_value(l.loss)', 6)} AS loss, any_value(l.batches) AS batches, any_value(correct) AS correct,
       any_value(total) AS total, {_round('any_value(100.0 * correct / total)', 6)} AS percent
FROM hits, (SELECT avg(loss) AS loss, count(*) AS batches FROM batch_losses) l""",
    "eval_accuracy": f"""WITH {_SAMPLE_SCORES}
SELECT correct, total, {_round('100.0 * correct / total', 6)} AS percent FROM hits""",
    "eval_loss": f"""WITH {_SAMPLE_SCORES}
SELECT {_round('avg(loss)', 9)} AS loss, count(*) AS batches FROM batch_losses""",
    "run_log": f"""
SELECT {', '.join(f'{value} AS {name}' for name, value in RUN.items())},
       0 AS epoch, iteration, value AS elapsed_time
FROM ({_EVENT_LOG})""",
    "run_log_rollup": f"""
SELECT 0 AS epoch, max(iteration) AS iteration,
       max(iteration) * {RUN['batch_size'] * RUN['nodes']} AS rows_seen,
       (SELECT count(*) FROM events) * {RUN['batch_size'] * RUN['nodes']} AS total_rows,
       {_round('max(iteration) * 100.0 / (SELECT count(*) FROM events)', 6)} AS percent,
       {_round('arg_max(value, iteration)', 6)} AS last_loss,
       {_round('sum(value)', 6)} AS interval_time
FROM ({_EVENT_LOG}) GROUP BY (iteration - 1) // 20 HAVING max(iteration) % 20 = 0""",
    "phase_rollup": f"""
SELECT event_type AS phase, grouping(event_type)::INTEGER AS is_total,
       {_round('sum(value)', 6)} AS seconds
FROM events GROUP BY ROLLUP (event_type)""",
}
