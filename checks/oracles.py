"""SQL that DuckDB runs to give the result each query must have.

Written against the tables, not against the library: metrics are computed from
the rows, ranks with window functions, quantiles by the database.
"""

from __future__ import annotations

import re

from desksort import taxonomy
from desksort.functions import patterns
from desksort.sources.feeds import MISSING_CELLS

from . import fixtures as fx
from .fixtures import quoted
from .stop_words import STOP_WORDS

ORACLES: dict[str, str] = {}

# What the library's NON_PRINTABLE means, without class intersection.
NON_PRINTABLE = r"[\x{0}-\x{8}\x{e}-\x{1b}\x{7f}-\x{84}\x{86}-\x{9f}\p{Cf}\p{Co}]"
EDGES = rf"^{patterns.WHITESPACE}+|{patterns.WHITESPACE}+$"


def sub(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {quoted(pattern)}, {quoted(replacement)}, '{flags}')"


def chain(expr: str, steps, flags: str = "g") -> str:
    for pattern, replacement in steps:
        expr = sub(expr, pattern, replacement, flags)
    return expr


def redact_sql(expr: str, kinds=None) -> str:
    steps = [(p, t) for k, p, t in patterns.PERSONAL_DATA if kinds is None or k in kinds]
    return chain(expr, steps, "gi")


def printable_sql(expr: str) -> str:
    return sub(expr, NON_PRINTABLE, "")


def collapse_sql(expr: str) -> str:
    return f"trim({sub(expr, patterns.WHITESPACE + '+', ' ')})"


def normalize_sql(expr: str) -> str:
    return f"lower({collapse_sql(chain(expr, [*patterns.MARKUP, *patterns.NOISE]))})"


def gate_sql(expr: str, low: int, high: int) -> str:
    return f"(SELECT CASE WHEN length(g) < {low} THEN '' ELSE substring(g, 1, {high}) END FROM (SELECT {expr} AS g))"


def clean_sql(expr: str, redact: bool = True) -> str:
    out = printable_sql(f"coalesce({expr}, '')")
    return gate_sql(normalize_sql(redact_sql(out) if redact else out), 10, 2000)


def query(name: str, ctes: list[str], body: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + body


def per_document(name: str, expr: str) -> None:
    query(name, [fx.PERSONAL], f"SELECT doc_id, {expr} AS text FROM personal")


# --- sources and standardising -------------------------------------------

MISSING = ", ".join(quoted(c) for c in MISSING_CELLS)


def present(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({MISSING}) THEN {c} END"


query("ticket_csv_scan", [fx.FEED], f"""
SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, {present('title')} AS subject,
       {present('description')} AS body, {present('category')} AS topic_group,
       {present('priority')} AS urgency_level FROM feed""")
query("ticket_csv_first_rows", [fx.FEED], f"""
SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, {present('category')} AS topic_group
FROM feed ORDER BY feed.ordinal LIMIT 100""")


def keyword_sql(lowered: str) -> str:
    """Best of (score, -place) over the categories; a list sort finds it."""
    entries = []
    for place, name in enumerate(taxonomy.CATEGORIES):
        words = taxonomy.KEYWORDS.get(name, ())
        score = " + ".join(
            f"CASE WHEN contains({lowered}, {quoted(w)}) THEN {len(w.split())} ELSE 0 END"
            for w in words
        ) or "0"
        entries.append(f"{{'s': {score}, 'p': {-place}, 'c': {quoted(name)}}}")
    best = f"(list_sort([{', '.join(entries)}], 'DESC'))[1]"
    return (f"(SELECT CASE WHEN b.s = 0 THEN {quoted(taxonomy.GENERAL)} ELSE b.c END "
            f"FROM (SELECT {best} AS b))")


def fragment_sql(category: str) -> str:
    branches = " ".join(
        f"WHEN contains(lower({category}), {quoted(w)}) THEN {quoted(name)}"
        for name, words in taxonomy.CATEGORY_FRAGMENTS
        for w in words
    )
    return f"CASE {branches} END"


def priority_sql(c: str) -> str:
    branches = " ".join(
        f"WHEN lower({c}) IN ({', '.join(quoted(n) for n in names)}) THEN {quoted(level)}"
        for level, names in taxonomy.PRIORITY_SPELLINGS.items()
    )
    return f"CASE {branches} ELSE {quoted(taxonomy.DEFAULT_PRIORITY)} END"


STANDARD = f"""standard AS (
  SELECT ordinal, 'it_service_' || ordinal AS ticket_id,
         CASE WHEN t = '' THEN substring(d, 1, 100) ELSE t END AS title,
         CASE WHEN d = '' THEN t ELSE d END AS description,
         coalesce({fragment_sql('category')}, {keyword_sql('low')}) AS category,
         {priority_sql('priority')} AS priority,
         'customer@company.com' AS customer_email, 'IT User' AS customer_name,
         'kaggle_it_service' AS source, category AS original_category
  FROM (SELECT *, coalesce(title, '') AS t, coalesce(description, '') AS d,
               lower(coalesce(title, '') || ' ' || coalesce(description, '')) AS low FROM feed)
  WHERE {sub('t', EDGES, '')} <> '' OR {sub('d', EDGES, '')} <> '')"""

query("standardized_tickets", [fx.FEED, STANDARD], "SELECT * FROM standard")
query("written_tickets", [fx.FEED, STANDARD], "SELECT * FROM standard")
query("standardized_from_csv", [f"""feed AS (
  SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, {present('title')} AS title,
         {present('description')} AS description, {present('category')} AS category,
         {present('priority')} AS priority FROM (WITH {fx.FEED} SELECT * FROM feed))""", STANDARD],
      "SELECT * FROM standard")
query("keyword_categories", [fx.PERSONAL],
      f"SELECT doc_id, {keyword_sql('lowered')} AS category "
      "FROM (SELECT doc_id, lower(text) AS lowered FROM personal)")
query("fragment_categories", [fx.FEED],
      f"SELECT ordinal, {fragment_sql('category')} AS mapped FROM feed")
query("priority_levels", [fx.FEED],
      f"SELECT ordinal, {priority_sql('priority')} AS priority FROM feed")
query("order_priority_levels", [], f"""
SELECT priority, count(*) AS count, count(*) * 100.0::double / sum(count(*)) OVER () AS percentage
FROM (SELECT {priority_sql("split_part(o_orderpriority, '-', 1)")} AS priority FROM orders)
GROUP BY priority""")

query("json_requests", [fx.REQUEST_ROWS], "SELECT * FROM judged")
query("rejected_requests", [fx.REQUEST_ROWS],
      "SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason")
query("response_tickets", [fx.RESPONSE_ROWS], "SELECT * FROM answers")
query("batch_request_tickets", [], """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
       role AS title, text AS description FROM conversations""")

# --- cleaning ------------------------------------------------------------

per_document("redacted_text", redact_sql("text"))
per_document("redacted_contacts", redact_sql("text", ("email", "phone", "url")))
per_document("printable_text", printable_sql("text"))
per_document("quiet_text", chain("text", patterns.NOISE))
per_document("normalized_text", normalize_sql("text"))
per_document("collapsed_text", collapse_sql("text"))
per_document("length_gated_text", gate_sql("text", 200, 1000))
per_document("cleaned_text", clean_sql("text"))
per_document("cleaned_text_unredacted", clean_sql("text", redact=False))
query("page_text_without_markup", [],
      f"SELECT page_id, {chain('html', patterns.MARKUP)} AS text FROM pages")
query("cleaned_pages", [], f"SELECT page_id, {clean_sql('html')} AS text FROM pages")

FIELDS = f"""fields AS (
  SELECT *, title_clean || ' ' || description_clean AS text_clean
  FROM (SELECT *, {clean_sql('title')} AS title_clean,
               {clean_sql('description')} AS description_clean FROM standard))"""
query("cleaned_fields", [fx.FEED, STANDARD, FIELDS],
      "SELECT ordinal, title_clean, description_clean, text_clean FROM fields")
joined = "coalesce(title, '') || ' ' || coalesce(description, '')"
query("cleaned_joined", [fx.FEED], f"SELECT ordinal, {clean_sql(joined)} AS text_clean FROM feed")


def stages_sql(source: str, column: str) -> str:
    """Nested selects: every pattern's hits on the text the one before left."""
    kinds = [k for k, _, _ in patterns.PERSONAL_DATA]
    inner = (f"SELECT {column} IS NOT NULL AS given, "
             f"{printable_sql(f'coalesce({column}, {quoted(str())})')} AS t FROM {source}")
    for kind, pattern, token in patterns.PERSONAL_DATA:
        inner = (f"SELECT * EXCLUDE (t), len(regexp_extract_all(t, {quoted('(?i)' + pattern)})) "
                 f"AS {kind}, {sub('t', pattern, token, 'gi')} AS t FROM ({inner})")
    staged = f"SELECT *, length({normalize_sql('t')}) AS size FROM ({inner})"
    hits = ", ".join(f"{{'counter': 'pii_{k}', 'n': sum({k})::bigint}}" for k in kinds)
    total = " + ".join(f"sum({k})::bigint" for k in kinds)
    counts = (
        "{'counter': 'total_processed', 'n': count(*) FILTER (given)}, "
        "{'counter': 'too_short', 'n': count(*) FILTER (given AND size < 10)}, "
        "{'counter': 'too_long', 'n': count(*) FILTER (given AND size > 2000)}, "
        "{'counter': 'truncated', 'n': count(*) FILTER (given AND size > 2000)}, "
        "{'counter': 'empty_after_cleaning', 'n': 0::bigint}"
    )
    return (f"SELECT '{column}' AS \"column\", unnest([{counts}, {hits}, "
            f"{{'counter': 'pii_total', 'n': {total}}}]) AS c FROM ({staged})")


query("cleaning_counters", [fx.FEED], f"""
SELECT "column", c.counter AS counter, c.n AS n
FROM ({stages_sql('feed', 'title')} UNION ALL {stages_sql('feed', 'description')})""")
query("personal_data_counts", [fx.PERSONAL], f"""
SELECT c.counter AS counter, c.n AS n FROM ({stages_sql('personal', 'text')})
WHERE starts_with(c.counter, 'pii_')""")

# --- duplicates, lengths, labels, splits ---------------------------------

query("unique_first", [], "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
query("unique_last", [], "SELECT max(doc_id) AS doc_id, text FROM documents GROUP BY text")
query("unique_only", [],
      "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text HAVING count(*) = 1")
query("duplicates_removed", [], """
SELECT count(*) AS initial_count, count(DISTINCT (role, text)) AS final_count,
       count(*) - count(DISTINCT (role, text)) AS removed FROM conversations""")

UNIQUE_FEED = """firsts AS (SELECT * FROM feed QUALIFY row_number() OVER (
  PARTITION BY title, description ORDER BY ordinal) = 1)"""
query("long_enough_texts", [fx.FEED, UNIQUE_FEED], f"""
SELECT ordinal, length(x) AS combined_length
FROM (SELECT ordinal, {clean_sql('title')} || ' ' || {clean_sql('description')} AS x FROM firsts)
WHERE length(x) >= 10""")

LENGTHS = "lengths AS (SELECT doc_id, length(text) AS length FROM documents)"
BAND = """band AS (SELECT quantile_cont(length, 0.01) AS low, quantile_cont(length, 0.99) AS high
  FROM lengths)"""
query("length_band", [LENGTHS, BAND],
      "SELECT round(low, 9) AS min_threshold, round(high, 9) AS max_threshold FROM band")
query("lengths_in_band", [LENGTHS, BAND],
      "SELECT doc_id, length FROM lengths, band WHERE length >= low AND length <= high")
query("length_band_stats", [LENGTHS, BAND], """
SELECT count(*) AS initial_count, count(*) FILTER (length BETWEEN low AND high) AS final_count,
       count(*) FILTER (length < low OR length > high) AS removed,
       round(max(low), 9) AS min_threshold, round(max(high), 9) AS max_threshold,
       count(*) FILTER (length < low) AS too_short, count(*) FILTER (length > high) AS too_long
FROM lengths, band""")
query("price_quantiles", [], """
SELECT l_returnflag, quantile, round(value, 9) AS value FROM (
  SELECT l_returnflag, unnest([0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]::double[]) AS quantile,
         unnest(quantile_cont(l_extendedprice, [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0])) AS value
  FROM lineitem GROUP BY l_returnflag)""")

LABELS = """labelled AS (SELECT row_number() OVER (ORDER BY category) - 1 AS label, category
  FROM (SELECT DISTINCT category FROM standard))"""
query("label_map", [fx.FEED, STANDARD, LABELS], "SELECT label, category FROM labelled")
query("label_mapping_record", [fx.FEED, STANDARD, LABELS], """
SELECT category, label, category AS back, count(*) OVER () AS num_classes FROM labelled""")
query("encoded_synthetic", [fx.FEED, fx.SYNTHETIC, STANDARD, LABELS], """
SELECT s.ordinal, s.category, m.label FROM synthetic s LEFT JOIN labelled m USING (category)""")


def quota_ctes(source: str, stratum: str) -> str:
    """Largest remainder for train, then for validation within the rest."""

    def share(name: str, size: str, draws: str, source: str) -> str:
        return f"""{name}_parts AS (
  SELECT *, (({size})::hugeint * {draws}) // sum({size}) OVER () AS base,
         (({size})::hugeint * {draws}) % sum({size}) OVER () AS rest FROM {source}),
{name}_ranked AS (
  SELECT *, {draws} - sum(base) OVER () AS spare,
         row_number() OVER (ORDER BY rest DESC, stratum) AS turn FROM {name}_parts),
{name}_shared AS (
  SELECT * EXCLUDE (base, rest, spare, turn),
         (base + CASE WHEN turn <= spare THEN 1 ELSE 0 END)::bigint AS {name} FROM {name}_ranked)"""

    return f"""sizes AS (SELECT {stratum} AS stratum, count(*) AS size FROM {source} GROUP BY 1),
drawn AS (SELECT *, (sum(size) OVER () - ceil(0.3::double * sum(size) OVER ()))::bigint AS n_train
          FROM sizes),
{share('train', 'size', 'n_train', 'drawn')},
held AS (SELECT *, size - train AS held,
         (sum(size - train) OVER () - ceil(0.5::double * sum(size - train) OVER ()))::bigint AS n_val
         FROM train_shared),
{share('val', 'held', 'n_val', 'held')},
quotas AS (SELECT stratum, size, train, val, held - val AS test FROM val_shared)"""


def split_cte(name: str, source: str, stratum: str, row_id: str, seed: int) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (turn, q_test, q_val),
         CASE WHEN turn <= q_test THEN 'test' WHEN turn <= q_test + q_val THEN 'val'
              ELSE 'train' END AS split
  FROM (SELECT s.*, q.test AS q_test, q.val AS q_val, row_number() OVER (
          PARTITION BY {stratum}
          ORDER BY md5('{seed}|' || {row_id}::varchar), {row_id}) AS turn
        FROM {source} s JOIN quotas q ON s.{stratum} = q.stratum))"""


query("split_by_source",
      [quota_ctes("documents", "source"), split_cte("parts", "documents", "source", "doc_id", 42)],
      "SELECT doc_id, source, split FROM parts")
query("split_by_event_type",
      [quota_ctes("events", "event_type"), split_cte("parts", "events", "event_type", "event_id", 7)],
      "SELECT event_id, event_type, split FROM parts")
query("split_quotas", [quota_ctes("events", "event_type")],
      "SELECT stratum AS event_type, size, train, val, test FROM quotas")
query("split_counts",
      [quota_ctes("documents", "lang"), split_cte("parts", "documents", "lang", "doc_id", 42)],
      "SELECT split, lang, count(*) AS count FROM parts GROUP BY ROLLUP (split, lang)")

AUGMENT = """SELECT {columns}, is_synthetic FROM (
  SELECT {columns}, false AS is_synthetic FROM {train}
  UNION ALL SELECT {columns}, true FROM {extra})
QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY is_synthetic, ordinal) = 1"""
query("augmented_train", [fx.FEED, fx.SYNTHETIC, STANDARD], AUGMENT.format(
    columns="ordinal, title, description, category", train="standard", extra="synthetic"))


def prepared_ctes(augment: bool = True) -> list[str]:
    out = [fx.FEED, fx.SYNTHETIC, STANDARD, f"""cleaned AS (
  SELECT *, length(text_clean) AS combined_length FROM (
    SELECT *, title_clean || ' ' || description_clean AS text_clean FROM (
      SELECT *, {clean_sql('title')} AS title_clean, {clean_sql('description')} AS description_clean
      FROM (SELECT * FROM standard QUALIFY row_number() OVER (
              PARTITION BY title, description ORDER BY ordinal) = 1))))""",
        "enough AS (SELECT * FROM cleaned WHERE combined_length >= 10)",
        """kept AS (SELECT * FROM enough WHERE combined_length BETWEEN
  (SELECT quantile_cont(combined_length, 0.01) FROM enough)
  AND (SELECT quantile_cont(combined_length, 0.99) FROM enough))""",
        """labelled AS (SELECT row_number() OVER (ORDER BY category) - 1 AS label, category
  FROM (SELECT DISTINCT category FROM kept))""",
        quota_ctes("kept", "category"),
        split_cte("parts", "kept", "category", "ticket_id", 42),
        "named AS (SELECT parts.*, label FROM parts JOIN labelled USING (category))",
        f"""extra AS (SELECT *, title_clean || ' ' || description_clean AS text_clean,
    length(title_clean || ' ' || description_clean) AS combined_length FROM (
  SELECT s.*, label, {clean_sql('title')} AS title_clean, {clean_sql('description')} AS description_clean
  FROM synthetic s LEFT JOIN labelled USING (category)))"""]
    columns = "ordinal, title, description, text_clean, combined_length, category, label"
    train = AUGMENT.format(columns=columns, train="(SELECT * FROM named WHERE split = 'train')",
                           extra="extra")
    out.append(f"""prepared AS (
  SELECT {columns}, split, false AS is_synthetic FROM named WHERE split <> 'train'
  UNION ALL SELECT {columns}, 'train', is_synthetic FROM ({train}))""")
    return out


query("preprocessed_tickets", prepared_ctes(), "SELECT * FROM prepared")
query("preprocessing_stats", prepared_ctes(), """
SELECT stat, NULL::varchar AS split, NULL::varchar AS category, n FROM (
  SELECT 'input_tickets' AS stat, (SELECT count(*) FROM standard) AS n
  UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM standard) - (SELECT count(*) FROM cleaned)
  UNION ALL SELECT 'short_texts_removed', (SELECT count(*) FROM cleaned WHERE combined_length < 10)
  UNION ALL SELECT 'extreme_cases_removed', (SELECT count(*) FROM enough) - (SELECT count(*) FROM kept)
  UNION ALL SELECT 'synthetic_tickets', (SELECT count(*) FROM synthetic)
  UNION ALL SELECT 'removed_augmentation_duplicates',
    (SELECT count(*) FROM synthetic) - (SELECT count(*) FROM prepared WHERE is_synthetic)
  UNION ALL SELECT 'original_tickets', (SELECT count(*) FROM kept)
  UNION ALL SELECT 'train_original_tickets', (SELECT count(*) FROM parts WHERE split = 'train')
  UNION ALL SELECT 'train_augmented_tickets', (SELECT count(*) FROM prepared WHERE is_synthetic)
  UNION ALL SELECT 'texts_in_several_splits', (SELECT count(*) FROM (
    SELECT text_clean FROM prepared GROUP BY text_clean HAVING count(DISTINCT split) > 1)))
UNION ALL SELECT 'tickets', split, category, count(*) FROM prepared GROUP BY split, category""")
query("leaked_texts", prepared_ctes(), """
SELECT splits, count(*) AS texts
FROM (SELECT count(DISTINCT split) AS splits FROM prepared GROUP BY text_clean) GROUP BY splits""")
query("prepared_counts", prepared_ctes(),
      "SELECT split, count(*) AS count FROM parts GROUP BY split")

# --- profiles ------------------------------------------------------------

query("category_counts", [fx.FEED, STANDARD], """
SELECT category, count(*) AS count, round(count(*) * 100.0::double / sum(count(*)) OVER (), 9) AS percentage
FROM standard GROUP BY category""")
query("event_type_counts", [], """
SELECT event_type, count(*) AS count,
       round(count(*) * 100.0::double / sum(count(*)) OVER (), 9) AS percentage
FROM events GROUP BY event_type""")
query("mapping_summary", [fx.FEED, STANDARD], """
SELECT original_category, category, count(*) AS count FROM standard
WHERE original_category IS NOT NULL GROUP BY ALL""")
query("length_stats", [fx.FEED, STANDARD], """
SELECT 'title' AS "column", round(avg(length(title)), 9) AS mean_length,
       min(length(title)) AS min_length, max(length(title)) AS max_length FROM standard
UNION ALL SELECT 'description', round(avg(length(description)), 9), min(length(description)),
       max(length(description)) FROM standard""")
query("dataset_record", [fx.FEED, STANDARD], """
SELECT 'total' AS part, 'tickets' AS key, count(*)::double AS value FROM standard
UNION ALL SELECT 'mean', 'avg_title_length', round(avg(length(title)), 9) FROM standard
UNION ALL SELECT 'mean', 'avg_description_length', round(avg(length(description)), 9) FROM standard
UNION ALL SELECT 'category', category, count(*) FROM standard GROUP BY category
UNION ALL SELECT 'priority', priority, count(*) FROM standard GROUP BY priority""")
query("class_weights", [], """
SELECT quality, count(*) AS count,
       round(sum(count(*)) OVER ()::double / (count(*) OVER () * count(*)), 9) AS weight
FROM labels GROUP BY quality""")

# --- evaluation ----------------------------------------------------------

THRESHOLD = "0.2::double"
BOTH = f"both_names AS (SELECT p.*, t.category AS true_category, q.category AS predicted_category " \
       "FROM preds p JOIN classes t ON p.label = t.label JOIN classes q ON p.pred = q.label)"
SEEN = "seen AS (SELECT label AS c FROM preds UNION SELECT pred FROM preds)"
PER_CLASS = """per_class AS (
  SELECT c, support, predicted, hits,
         CASE WHEN predicted = 0 THEN 0 ELSE hits::double / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE hits::double / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0
              ELSE 2.0::double * hits / (support + predicted) END AS f1
  FROM (SELECT c, (SELECT count(*) FROM preds WHERE label = c) AS support,
               (SELECT count(*) FROM preds WHERE pred = c) AS predicted,
               (SELECT count(*) FROM preds WHERE label = c AND pred = c) AS hits FROM seen))"""

query("confusion_matrix", [fx.PREDICTIONS, SEEN], """
SELECT label, pred, count, round(count::double / nullif(sum(count) OVER (PARTITION BY label), 0), 9) AS share
FROM (SELECT a.c AS label, b.c AS pred,
             (SELECT count(*) FROM preds p WHERE p.label = a.c AND p.pred = b.c) AS count
      FROM seen a, seen b)""")
query("confusion_matrix_wide", [fx.PREDICTIONS], "SELECT label, " + ", ".join(
    f"count(*) FILTER (pred = {c}) AS pred_{c}" for c in range(fx.PREDICTION_CLASSES)
) + " FROM preds GROUP BY label")
query("agreement_metrics", [fx.PREDICTIONS, SEEN, PER_CLASS, """sums AS (
  SELECT sum(support)::double AS n, sum(hits)::double AS h,
         sum(support::double * predicted) AS x, sum(support::double * support) AS tt,
         sum(predicted::double * predicted) AS pp FROM per_class)"""], """
SELECT round((SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM preds), 9) AS accuracy,
  round((SELECT avg(recall) FROM per_class WHERE support > 0), 9) AS balanced_accuracy,
  round((SELECT sum(f1 * support) / sum(support) FROM per_class), 9) AS f1_weighted,
  round((SELECT avg(f1) FROM per_class), 9) AS f1_macro,
  round((SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM preds), 9) AS f1_micro,
  round((SELECT sum(precision * support) / sum(support) FROM per_class), 9) AS precision_weighted,
  round((SELECT avg(precision) FROM per_class), 9) AS precision_macro,
  round((SELECT sum(recall * support) / sum(support) FROM per_class), 9) AS recall_weighted,
  round((SELECT avg(recall) FROM per_class), 9) AS recall_macro,
  round((h / n - x / (n * n)) / (1 - x / (n * n)), 9) AS cohen_kappa,
  round((h * n - x) / (sqrt(n * n - tt) * sqrt(n * n - pp)), 9) AS matthews_corrcoef
FROM sums""")
query("classification_report", [fx.PREDICTIONS, fx.CLASSES, SEEN, PER_CLASS], """
SELECT category AS name, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, support FROM per_class JOIN classes ON c = label
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits)::double / sum(support), 9), sum(support)::bigint FROM per_class
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
       sum(support)::bigint FROM per_class
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
       round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
       sum(support)::bigint FROM per_class""")
CONF_SQL = f"""
SELECT count(*) AS n, round(avg(confidence), 9) AS mean_confidence,
  round(stddev_pop(confidence), 9) AS std_confidence,
  count(*) FILTER (confidence >= {THRESHOLD}) AS n_high_confidence,
  count(*) FILTER (confidence < {THRESHOLD}) AS n_low_confidence,
  round(avg(CASE WHEN confidence >= {THRESHOLD} THEN 1.0 ELSE 0.0 END), 9) AS high_confidence_rate,
  round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FILTER (confidence >= {THRESHOLD}), 9) AS accuracy_high_confidence,
  round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FILTER (confidence < {THRESHOLD}), 9) AS accuracy_low_confidence,
  count(*) FILTER (confidence < {THRESHOLD}) AS n_uncategorized,
  round(count(*) FILTER (confidence < {THRESHOLD}) * 100.0::double / count(*), 9) AS uncategorized_percentage
FROM preds"""
query("confidence_summary", [fx.PREDICTIONS], CONF_SQL)
query("median_confidence", [fx.PREDICTIONS],
      "SELECT 0.5::double AS quantile, round(median(confidence), 9) AS value FROM preds")
query("error_rate", [fx.PREDICTIONS], """
SELECT count(*) AS n, count(*) FILTER (label <> pred) AS n_errors,
       round(count(*) FILTER (label <> pred)::double / count(*), 9) AS error_rate FROM preds""")
query("category_error_rates", [fx.PREDICTIONS, fx.CLASSES, BOTH], """
SELECT true_category AS category, count(*) FILTER (label <> pred) AS errors, count(*) AS total,
       round(count(*) FILTER (label <> pred)::double / count(*), 9) AS error_rate
FROM both_names GROUP BY true_category""")
PATTERNS = """SELECT true_category, predicted_category, count(*) AS count,
  round(count(*)::double / sum(count(*)) OVER () * 100, 9) AS percentage, min(id) AS first_seen
  FROM both_names WHERE label <> pred GROUP BY true_category, predicted_category"""
query("error_patterns", [fx.PREDICTIONS, fx.CLASSES, BOTH], PATTERNS)
query("top_error_patterns", [fx.PREDICTIONS, fx.CLASSES, BOTH], f"""
SELECT row_number() OVER (ORDER BY count DESC, first_seen) AS rank,
       * EXCLUDE (first_seen) FROM ({PATTERNS}) QUALIFY rank <= 10""")
query("error_confidence", [fx.PREDICTIONS], """
SELECT label <> pred AS is_error, count(*) AS n, round(avg(confidence), 9) AS mean_confidence,
       round(stddev_pop(confidence), 9) AS std_confidence FROM preds GROUP BY is_error""")
query("confident_errors", [fx.PREDICTIONS, fx.CLASSES, BOTH], """
SELECT text_clean, true_category, predicted_category, round(confidence, 9) AS confidence
FROM both_names WHERE label <> pred ORDER BY both_names.confidence DESC, id LIMIT 50""")
SERIES = """series AS (SELECT CASE WHEN label = pred THEN 'correct' ELSE 'error' END AS series,
  confidence AS x FROM preds)"""
query("confidence_histogram", [fx.PREDICTIONS, SERIES, """
ranges AS (SELECT series, min(x) AS lo, max(x) AS hi, count(*) AS n FROM series GROUP BY series),
bins AS (SELECT series, lo, hi, n, i::integer AS bin, lo + i * ((hi - lo) / 50) AS low,
  CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50) END AS high
  FROM ranges, range(50) t(i))"""], """
SELECT series, bin, round(low, 9) AS low, round(high, 9) AS high, count,
       round(count / (n * ((hi - lo) / 50)), 9) AS density
FROM (SELECT b.*, (SELECT count(*) FROM series s WHERE s.series = b.series AND s.x >= b.low
                   AND (s.x < b.high OR b.bin = 49 AND s.x <= b.high)) AS count FROM bins b)""")


def box_sql(source: str) -> str:
    return f"""
SELECT series, round(q1, 9) AS q1, round(median, 9) AS median, round(q3, 9) AS q3,
  round(least(min(x) FILTER (near), q1), 9) AS whisker_low,
  round(greatest(max(x) FILTER (near), q3), 9) AS whisker_high,
  count(*) FILTER (NOT near) AS outliers
FROM (SELECT series, x, q1, median, q3,
             x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS near
      FROM {source} JOIN (SELECT series, quantile_cont(x, 0.25) AS q1, median(x) AS median,
                            quantile_cont(x, 0.75) AS q3 FROM {source} GROUP BY series)
      USING (series))
GROUP BY series, q1, median, q3"""


query("confidence_box_plot", [fx.PREDICTIONS, SERIES], box_sql("series"))
query("event_value_box_plot", ["points AS (SELECT event_type AS series, value AS x FROM events)"],
      box_sql("points"))
query("split_evaluation", [fx.PREDICTIONS, SEEN, PER_CLASS], f"""
SELECT 'val' AS split, round(sum(hits)::double / sum(support), 9) AS accuracy,
  round(sum(f1 * support) / sum(support), 9) AS f1_weighted,
  round(sum(precision * support) / sum(support), 9) AS precision_weighted,
  round(sum(recall * support) / sum(support), 9) AS recall_weighted,
  (SELECT count(*) FROM preds WHERE confidence < {THRESHOLD}) AS n_uncategorized,
  round((SELECT count(*) FROM preds WHERE confidence < {THRESHOLD}) * 100.0::double / sum(support), 9)
    AS uncategorized_percentage
FROM per_class""")
LINES = [
    ("OVERALL METRICS", 1, "printf('Accuracy: %.4f', accuracy)"),
    ("OVERALL METRICS", 2, "printf('Balanced Accuracy: %.4f', balanced_accuracy)"),
    ("OVERALL METRICS", 3, "printf('F1-Score (weighted): %.4f', f1_weighted)"),
    ("OVERALL METRICS", 4, "printf('F1-Score (macro): %.4f', f1_macro)"),
    ("OVERALL METRICS", 5, "printf('Precision (weighted): %.4f', precision_weighted)"),
    ("OVERALL METRICS", 6, "printf('Recall (weighted): %.4f', recall_weighted)"),
    ("OVERALL METRICS", 7, "printf('Cohen''s Kappa: %.4f', cohen_kappa)"),
    ("CONFIDENCE ANALYSIS", 1, "printf('Mean confidence: %.4f', mean_confidence)"),
    ("CONFIDENCE ANALYSIS", 2, "printf('High confidence rate: %.2f%%', high_confidence_rate * 100)"),
    ("CONFIDENCE ANALYSIS", 3, "printf('Accuracy (high conf): %.4f', accuracy_high_confidence)"),
    ("CONFIDENCE ANALYSIS", 4, "printf('Accuracy (low conf): %.4f', accuracy_low_confidence)"),
    ("KEY INSIGHTS", 1, "printf('Model correctly classifies %.2f%% of tickets', accuracy * 100)"),
    ("KEY INSIGHTS", 2,
     "printf('%.2f%% can be auto-assigned with high confidence', high_confidence_rate * 100)"),
    ("KEY INSIGHTS", 3,
     "printf('Errors have %.2f avg confidence (vs %.2f for correct)', "
     "(SELECT avg(confidence) FROM preds WHERE label <> pred), "
     "(SELECT avg(confidence) FROM preds WHERE label = pred))"),
    ("KEY INSIGHTS", 4,
     "printf('Strong agreement between model and ground truth (Kappa: %.4f)', cohen_kappa)"),
]
SUMMARY = (f"figures AS (SELECT * FROM ({ORACLES['agreement_metrics']}) a, "
           f"({ORACLES['confidence_summary']}) c)")
query("evaluation_summary", [fx.PREDICTIONS, fx.CLASSES, BOTH, SUMMARY], " UNION ALL ".join(
    f"SELECT {quoted(s)} AS section, {n} AS line_no, {t} AS text FROM figures" for s, n, t in LINES
) + f""" UNION ALL SELECT 'TOP MISCLASSIFICATION PATTERNS', rank,
  printf('%s → %s: %d (%.2f%%)', true_category, predicted_category, count, percentage)
FROM (SELECT *, row_number() OVER (ORDER BY count DESC, first_seen) AS rank FROM ({PATTERNS}))
WHERE rank <= 5""")

# --- scores and routing --------------------------------------------------

query("softmax_scores", [], """
SELECT vec_id, list_position(e, list_max(e)) - 1 AS pred, round(list_max(e) / list_sum(e), 6) AS confidence
FROM (SELECT vec_id, list_transform(x, lambda v: exp(v - m)) AS e
      FROM (SELECT vec_id, x, list_max(x) AS m
            FROM (SELECT vec_id, list_transform(embedding, lambda v: v::double * 10) AS x
                  FROM embeddings)))""")
query("class_probabilities", [fx.PREDICTIONS, fx.CLASSES], """
SELECT id, c.category, round(probs[c.label + 1], 9) AS probability FROM preds, classes c""")
query("top_classes", [fx.PREDICTIONS, fx.CLASSES], """
SELECT id, rank, category, round(probability, 9) AS probability
FROM (SELECT id, category, probs[c.label + 1] AS probability,
             row_number() OVER (PARTITION BY id ORDER BY probs[c.label + 1] DESC, c.label) - 1 AS rank
      FROM preds, classes c) WHERE rank < 3""")
RECORDS = """records AS (SELECT id, category AS predicted_category, confidence
  FROM preds JOIN classes ON preds.pred = classes.label)"""
query("review_flags", [fx.PREDICTIONS, fx.CLASSES, RECORDS], f"""
SELECT id, confidence >= {THRESHOLD} AS confident, confidence < {THRESHOLD} AS needs_manual_review,
  CASE WHEN confidence < {THRESHOLD} THEN 'Uncategorized' ELSE predicted_category END AS category
FROM records""")
VALID = ", ".join(quoted(c) for c in taxonomy.CATEGORIES)
SECOND = f"""second AS (
  SELECT id, CASE WHEN s IN ({VALID}) THEN s WHEN upper(s) = 'UNCERTAIN' THEN 'Uncategorized' END AS category,
    CASE WHEN s IN ({VALID}) THEN 0.7::double WHEN upper(s) = 'UNCERTAIN' THEN 0.0::double END AS confidence,
    CASE WHEN s IN ({VALID}) THEN 'gpt' WHEN upper(s) = 'UNCERTAIN' THEN 'gpt_unknown' END AS method
  FROM (SELECT id, trim(answer) AS s FROM opinions))"""
query("second_opinions", [fx.OPINIONS, SECOND],
      "SELECT id, category AS predicted_category, confidence, method FROM second")
query("hybrid_predictions", [fx.PREDICTIONS, fx.CLASSES, fx.OPINIONS, RECORDS, SECOND], f"""
SELECT r.id, CASE WHEN wins THEN s.category ELSE r.predicted_category END AS predicted_category,
  round(CASE WHEN wins THEN s.confidence ELSE r.confidence END, 9) AS confidence,
  unsure AND NOT wins AS needs_manual_review,
  CASE WHEN wins THEN 'gpt' WHEN unsure AND s.category IS NOT NULL THEN 'gpt_unknown' ELSE 'ml' END
    AS classification_method,
  CASE WHEN unsure THEN r.predicted_category END AS ml_category,
  round(CASE WHEN unsure THEN r.confidence END, 9) AS ml_confidence,
  CASE WHEN unsure THEN s.category END AS second_category
FROM (SELECT records.*, confidence < {THRESHOLD} AS unsure FROM records) r
JOIN second s USING (id),
LATERAL (SELECT unsure AND coalesce(s.category <> 'Uncategorized', false) AS wins)""")
COUNTERS = """SELECT predicted_category, count(*) AS predictions,
  round(avg(confidence), 9) AS average_confidence FROM records GROUP BY ROLLUP (predicted_category)"""
query("scoring_counters", [fx.PREDICTIONS, fx.CLASSES, RECORDS], COUNTERS)
query("streamed_counters", [fx.PREDICTIONS, fx.CLASSES, RECORDS], COUNTERS)
query("prediction_json", [fx.PREDICTIONS, fx.CLASSES, RECORDS], """
SELECT id, predicted_category, round(confidence, 9) AS confidence, 2 AS fields FROM records""")
query("batch_envelopes", [], """
SELECT conv_id, count(*) OVER (PARTITION BY conv_id) AS count,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place,
  role AS predicted_category, turn::double AS confidence FROM conversations""")

# --- features and models -------------------------------------------------

# The list goes through the same cutting into words as the texts.
STOP = ", ".join(quoted(w) for w in sorted({w for s in STOP_WORDS for w in re.findall(r"\w{2,}", s)}))
WORDS = f"""words AS (
  SELECT doc_id, list_filter(regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                             lambda w: NOT list_contains([{STOP}], w)) AS w FROM documents),
terms AS (SELECT doc_id, w || CASE WHEN len(w) > 1
    THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    ELSE [] END AS t FROM words)"""
COUNTS = """counted AS (SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(t) AS term FROM terms) GROUP BY doc_id, term)"""
KNOWN = """known AS (
  SELECT row_number() OVER (ORDER BY term) - 1 AS index, term, tf, df,
         ln((1 + n) / (1 + df)::double) + 1 AS idf
  FROM (SELECT term, sum(tf)::bigint AS tf, count(*) AS df, (SELECT count(*) FROM documents) AS n
        FROM counted GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.95::double * any_value(
          (SELECT count(*) FROM documents))
        ORDER BY sum(tf) DESC, term LIMIT 10000))"""
query("document_words", [WORDS], "SELECT doc_id, array_to_string(w, ' ') AS words FROM words")
query("document_terms", [WORDS], "SELECT doc_id, array_to_string(t, '|') AS terms FROM terms")
query("term_counts", [WORDS, COUNTS], "SELECT doc_id, term, tf FROM counted")
query("vocabulary", [WORDS, COUNTS, KNOWN],
      "SELECT index, term, tf, df, round(idf, 9) AS idf FROM known")
query("tfidf_weights", [WORDS, COUNTS, KNOWN], """
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 9) AS weight
FROM (SELECT c.doc_id, c.term, c.tf * k.idf AS raw FROM counted c JOIN known k USING (term))""")
SCORER = """odds AS (SELECT doc_id, [a::float, (0.5 - a / 2)::float, (a / 4)::float, (0.5 - 3 * a / 4)::float] AS p
  FROM (SELECT doc_id, (length(text) % 8 + 1) / 16.0::double AS a FROM documents))"""
query("batch_scorer_predictions", [SCORER], """
SELECT doc_id, list_position(p, list_max(p)) - 1 AS pred, list_max(p)::double AS confidence,
  (['a', 'b', 'c', 'd'])[list_position(p, list_max(p))] AS predicted_category,
  CASE WHEN list_max(p) < 0.6::double THEN 'Uncategorized'
       ELSE (['a', 'b', 'c', 'd'])[list_position(p, list_max(p))] END AS thresholded_category
FROM odds""")
for _name in ("rejected_by_the_job", "streamed_rejects"):
    query(_name, [fx.REQUEST_ROWS], "SELECT id, reason FROM judged WHERE reason IS NOT NULL")
query("rejected_batches", [], """
SELECT conv_id, CASE WHEN conv_id % 9 = 4 THEN 'invalid_json' ELSE 'missing_field' END AS reason
FROM conversations WHERE conv_id % 9 IN (4, 7) GROUP BY conv_id""")

# A trained model's numbers are not SQL's to compute. Each of these rows is one that
# the library proved by other means; SQL says which rows there must be.
TRAIN = "train_rows AS (SELECT ordinal AS doc_id, text_clean AS text FROM named WHERE split = 'train')"
query("model_coefficients", [
    *prepared_ctes(), TRAIN, *(c.replace("FROM documents", "FROM train_rows") for c in (WORDS, COUNTS, KNOWN)),
    "classes AS (SELECT DISTINCT category, label FROM labelled)"], """
SELECT label, category, term, true AS at_optimum FROM classes, (SELECT term FROM known UNION ALL SELECT '')""")
query("model_info", prepared_ctes(), """
SELECT 'baseline' AS model_type, 0.6::double AS confidence_threshold, (SELECT count(*) FROM labelled) AS num_classes,
  label, category FROM labelled""")
query("classifier_predictions", prepared_ctes(),
      "SELECT ordinal, label, true AS certified FROM named WHERE split <> 'train'")
query("trained_and_validated", prepared_ctes(),
      "SELECT 'val' AS split, count(*) AS tickets, true AS certified FROM named WHERE split = 'val'")
query("scored_tickets", prepared_ctes(), """
SELECT ordinal, 'baseline' AS model_type, (SELECT count(*) FROM labelled) AS classes, true AS certified FROM feed""")
query("scored_requests", [fx.REQUEST_ROWS], "SELECT id, true AS certified FROM judged WHERE reason IS NULL")
query("streamed_scores", [fx.REQUEST_ROWS], """
SELECT id, 'ml' AS classification_method, true AS certified FROM judged WHERE reason IS NULL""")
query("scored_batches", [], """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
  count(*) OVER (PARTITION BY conv_id) AS count, true AS certified
FROM conversations WHERE conv_id % 9 NOT IN (4, 7)""")
query("streamed_cleaning", [], f"SELECT doc_id, {clean_sql('text')} AS text_clean FROM documents")


# Columns that are 32-bit in the library; DuckDB counts in 64.
INTEGERS = {
    "batch_request_tickets": ["pos"],
    "model_coefficients": ["label"],
    "model_info": ["num_classes", "label"],
    "classifier_predictions": ["label"],
    "trained_and_validated": ["tickets"],
    "scored_tickets": ["classes"],
    "scored_batches": ["pos"],
    "long_enough_texts": ["combined_length"],
    "lengths_in_band": ["length"],
    "label_map": ["label"],
    "label_mapping_record": ["label", "num_classes"],
    "encoded_synthetic": ["label"],
    "preprocessed_tickets": ["combined_length", "label"],
    "leaked_texts": ["splits"],
    "length_stats": ["max_length", "min_length"],
    "top_error_patterns": ["rank"],
    "evaluation_summary": ["line_no"],
    "top_classes": ["rank"],
    "batch_envelopes": ["place"],
    "term_counts": ["tf"],
    "vocabulary": ["index"],
}
for _name, _columns in INTEGERS.items():
    _casts = ", ".join(f'"{c}"::INTEGER AS "{c}"' for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]})"
