"""DuckDB twins of the training-data queries that SQL can express."""

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2_SQL = f"""
WITH w AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
), first AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT doc_id, list(DISTINCT j) AS js FROM (
    SELECT win.doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN first ON win.k = first.k AND m < win.doc_id
  ) GROUP BY doc_id
), each AS (
  SELECT w.doc_id, ws, coalesce(js, []) AS js FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(js) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(js, i)), ' ')) AS kept_sha256
FROM each
"""

OP4_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT e.b, r.root FROM reach r JOIN both_ways e ON r.doc_id = e.a
), least AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(least.root, d.doc_id) AS component_id,
  coalesce(least.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""


def _op3_sql(least_tokens: int, span: int, share: float) -> str:
    """Word by word, without seeds: all alignments with enough equal places, and of those the fullest stretch."""
    words = r"regexp_split_to_array(trim(lower(coalesce(text, '')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+')"
    width = f"least({span}, m)"
    return f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents WHERE doc_id IS NOT NULL),
items AS MATERIALIZED (SELECT * FROM (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) >= {least_tokens}),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM docs),
iw AS (SELECT item_id, len(w) AS m, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM items),
equal AS (SELECT doc_id, item_id, m, pos - place AS shift, place FROM dw JOIN iw ON dw.word = iw.word),
aligned AS MATERIALIZED (
  SELECT doc_id, item_id, shift, any_value(m) AS m, list(place) AS places FROM equal GROUP BY doc_id, item_id, shift HAVING count(*) >= ceil(least({span}, any_value(m)) * {share})
), best AS (
  SELECT doc_id, item_id, ceil({width} * {share}) AS enough,
    list_max(list_transform(places, lambda p: len(list_filter(places, lambda q: q >= least(p, m - {width}) AND q < least(p, m - {width}) + {width})))) AS matched FROM aligned
)
SELECT doc_id, count(*) AS n_items, list_sort(list(item_id)) AS item_ids
FROM (SELECT DISTINCT doc_id, item_id FROM best WHERE matched >= enough) GROUP BY doc_id
"""


def op3_sql() -> str:
    from .decontamination import MIN_TOKENS, SHARE, SPAN

    return _op3_sql(MIN_TOKENS, SPAN, SHARE)
