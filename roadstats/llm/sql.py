"""DuckDB SQL for the contract queries that SQL can express."""

_COUNT = "len(regexp_extract_all(coalesce(text, ''), '{}'))"
_SPACE = _COUNT.format(r"[^\x20\x09-\x0D]+")
_ALNUM = _COUNT.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op8_token_counts": f"""WITH d AS (
  SELECT source, lang, quality, toxic, {_SPACE} AS space, {_ALNUM} AS alnum
  FROM documents LEFT JOIN (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)
  WHERE coalesce(quality, 1) <> 0)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM (
  SELECT source, lang, CASE WHEN toxic = 1 THEN 'alnum-2' ELSE 'space-1' END AS tokenizer,
         CASE WHEN toxic = 1 THEN alnum ELSE space END AS n FROM d)
GROUP BY ALL""",
    "op11_collocations": f"""WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS parts, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS cut, parts FROM c),
scored AS (SELECT x.*, l.f AS l, r.f AS r, (1000000 * a * a) // (l.f * r.f) AS score FROM cuts x
  JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.parts[1 : cut], ' ')
  JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.parts[cut + 1 : x.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, inside, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(parts[1 : 2], ' '), array_to_string(parts[2 : 3], ' ')]) AS inside FROM c WHERE k = 3) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n, CAST(score AS BIGINT) AS score
FROM best b JOIN n ON n.lang = b.lang LEFT JOIN longer ON longer.lang = b.lang AND longer.inside = b.phrase
WHERE coalesce(100 * longer.f, 0) < 50 * a QUALIFY rank <= 2000""",
    "op13_negatives": """WITH e AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, e.id, e.label = a.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM e a JOIN e ON e.id <> a.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""",
}
