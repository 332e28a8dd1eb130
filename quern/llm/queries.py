"""The queries and SQL of this subpackage, by name."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = {
    "toxic": ("p1_found", "p1_scores", "p1_rates"),
    "leaks": ("p2_found", "p2_overlaps", "p2_links", "p2_members"),
    "neardup": ("p3_found", "p3_classes"),
    "sample": ("p4_found", "p4_sample", "p4_report"),
    "unify": ("p5_found", "p5_forms", "p5_classes"),
    "pairs": ("p6_found", "p6_clauses"),
    "bpe": ("p7_ids",),
    "mixing": ("p8_found", "p8_mix", "p8_report"),
    "spans": ("p9_found", "p9_shares"),
}


def _lazy(module: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return getattr(importlib.import_module(f"quern.llm.{module}"), name)(spark, folder)

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _lazy(module, name) for module, names in _MODULES.items() for name in names}


# p4_found and p9_found are expressible in SQL; the other results rest on
# models, the one form of texts or exact tokens, which SQL lacks, and are tested
# against brute force, round trips or held-out rows.
_P4 = """
WITH c AS (
  SELECT metadata.conversation_id AS cid,
         coalesce(lower(trim(tags.persona)), 'unknown') AS persona,
         coalesce(lower(trim(tags.tone)), 'unknown') AS tone,
         coalesce(lower(trim(tags.domain[1])), 'unknown') AS first_domain
  FROM conversation),
s AS (SELECT floor(count(DISTINCT cid) / 4) AS size FROM c),
n AS (SELECT persona, tone, first_domain, count(DISTINCT cid) AS have FROM c GROUP BY ALL)
SELECT t.persona, t.tone, t.first_domain
FROM sample_targets t CROSS JOIN s LEFT JOIN n
  ON n.persona = lower(trim(t.persona)) AND n.tone = lower(trim(t.tone)) AND n.first_domain = lower(trim(t.first_domain))
WHERE coalesce(have, 0) < t.min_rows OR coalesce(have, 0) < t.target_share * s.size
"""


_P9 = """
WITH w AS (SELECT doc_id, i, substr(text, i, 150) AS s FROM (SELECT doc_id, text, unnest(range(1, length(text) - 148)) AS i FROM documents WHERE length(text) >= 150)),
g AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)),
h AS (SELECT DISTINCT doc_id, i FROM w WHERE s IN (SELECT s FROM g)),
k AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 150 THEN 0 ELSE 1 END AS fresh FROM h),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS stretch FROM k)
SELECT doc_id, min(i) - 1 AS span_start, max(i) + 149 AS span_end FROM r GROUP BY doc_id, stretch
"""


def oracle_sql() -> dict[str, str]:
    return {"p4_found": _P4, "p9_found": _P9}
