"""SQL building blocks for checking results on a second engine.

Each block is a common table expression over the given tables; ``compose`` puts
in front of a query the blocks it needs.
"""

from __future__ import annotations

import re

from listora.operators import prompts
from listora.plans.fixture import LISTING_SQL, REPLY_SQL
from listora.settings import Settings

S = Settings()
BLOCKS: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql


def compose(sql: str) -> str:
    """The query with every block it mentions, in dependency order."""
    names = list(BLOCKS)
    needed: set[str] = set()
    queue = [sql]
    while queue:
        text = queue.pop()
        for name in names:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                queue.append(BLOCKS[name])
    parts = [f"{n} AS ({BLOCKS[n]})" for n in names if n in needed]
    if not parts:
        return sql
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + sql


def txt(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('nan','None') THEN trim({c}) END"


def boo(c: str) -> str:
    return f"coalesce(lower(trim({c})) NOT IN ('false','0','no','n',''), false)"


def settle(x: str, digits: int) -> str:
    """Half to even on decimals, as the engine rounds its means."""
    return f"round_even(CAST({x} AS DECIMAL(30, 9)), {digits})::DOUBLE"


def has(c: str) -> str:
    return f"coalesce(trim({c}) <> '' AND lower({c}) <> 'nan', false)"


# --------------------------------------------------------------- up to cleaning

block("l_raw", LISTING_SQL.format(events="events", customer="customer", nation="nation", region="region"))

block("l_typed", f"""
SELECT l_raw.* REPLACE (
  {', '.join(f'{txt(c)} AS {c}' for c in 'name category street_address city region email website description'.split())},
  {', '.join(f'{boo(c)} AS {c}' for c in ('is_temporarily_closed', 'is_permanently_closed'))})
FROM l_raw""")

block("l_clean", r"""
SELECT q.* EXCLUDE (digits, dialled, address0),
  CASE WHEN regexp_full_match(regexp_replace(dialled, '^490([0-9])', '49\1'), '49[0-9]{6,11}')
       THEN '+' || regexp_replace(dialled, '^490([0-9])', '49\1') END AS phone_normalized,
  CASE WHEN regexp_full_match(address0, '[^@\s]+@[^@\s]+\.[^@\s]+') THEN address0 END AS email_normalized,
  coalesce(regexp_full_match(address0, '[^@\s]+@[^@\s]+\.[^@\s]+'), false) AS email_syntax_valid,
  CASE WHEN trim(category) <> '' THEN array_to_string(list_transform(
     regexp_extract_all(category, '\p{L}+|[^\p{L}]+'),
     lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '') END AS category_normalized,
  NOT is_permanently_closed AND NOT is_temporarily_closed AS is_active
FROM (
  SELECT p.*, CASE WHEN phone LIKE '+%' THEN digits WHEN digits LIKE '00%' THEN substr(digits, 3)
                   WHEN digits LIKE '0%' THEN '49' || substr(digits, 2) ELSE '49' || digits END AS dialled
  FROM (
    SELECT t.* REPLACE (
      CASE WHEN score BETWEEN 0 AND 5 THEN score END AS score,
      CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS lat,
      CASE WHEN lng BETWEEN -180 AND 180 THEN lng END AS lng),
      regexp_replace(phone, '[^0-9]', '', 'g') AS digits,
      lower(trim(email)) AS address0
    FROM l_typed t WHERE name IS NOT NULL AND length(name) >= 2) p) q""")

# ------------------------------------------------------------ entity resolution


def exact(source: str, name: str) -> None:
    place, cid = (f"coalesce(trim({c}) <> '', false)" for c in ("place_id", "cid"))
    block(f"{name}_place", f"""
SELECT * FROM {source} WHERE NOT {place}
UNION ALL
SELECT * FROM {source} WHERE {place}
QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY collected_at DESC NULLS LAST, row_id) = 1""")
    block(name, f"""
SELECT * FROM {name}_place WHERE NOT {cid}
UNION ALL
SELECT * FROM {name}_place WHERE {cid}
QUALIFY row_number() OVER (PARTITION BY cid
  ORDER BY {place} DESC, collected_at DESC NULLS LAST, row_id) = 1""")


exact("l_typed", "x_typed")
exact("l_clean", "x_clean")

NO_ID = "coalesce(trim(place_id), '') = '' AND coalesce(trim(cid), '') = ''"
PROCESSING = "coalesce(trim(cid) <> '', false) DESC, coalesce(trim(place_id) <> '', false) DESC, collected_at DESC NULLS LAST, row_id"


def sorted_key(text: str) -> str:
    return (
        f"array_to_string(list_sort(list_filter(string_split_regex({text}, '\\s+'), "
        "lambda w: w <> '')), ' ')"
    )


KEY = sorted_key("coalesce(name, '') || ' ' || coalesce(street_address, '')")


def masks(source: str, ids: str, text: str) -> str:
    """Per text the positions of each character, as one bit mask a character."""
    return f"""
SELECT {ids}, map(list(ch), list(m)) AS masks FROM (
  SELECT {ids}, ch, sum(1::HUGEINT << (i - 1))::HUGEINT AS m FROM (
    SELECT {ids}, unnest(string_split({text}, '')) AS ch,
           generate_subscripts(string_split({text}, ''), 1) AS i FROM {source})
  GROUP BY {ids}, ch) GROUP BY {ids}"""


def lcs(size_a: str, masks_a: str, text_b: str) -> str:
    """Bit-parallel longest common subsequence (Hyyro 2004)."""
    full = f"((1::HUGEINT << {size_a}) - 1)"
    return (
        f"({size_a} - bit_count(list_reduce(list_transform(string_split({text_b}, ''), "
        f"lambda ch: coalesce({masks_a}[ch], 0::HUGEINT)), "
        f"lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}, {full})))"
    )


block("f_rows", f"""
SELECT zip_code AS block, {KEY} AS k, * FROM x_clean
WHERE {NO_ID} AND zip_code IS NOT NULL""")
block("f_keys", f"""
SELECT *, length(k) AS n, row_number() OVER (PARTITION BY block ORDER BY {PROCESSING}) AS ord
FROM (SELECT * FROM f_rows QUALIFY row_number() OVER (PARTITION BY block, k ORDER BY {PROCESSING}) = 1)""")
block("f_masks", masks("f_keys", "block, ord", "k"))
block("f_edges", f"""
SELECT a.block, a.ord AS src, b.ord AS dst, 200.0 * {lcs('a.n', 'm.masks', 'b.k')} / (a.n + b.n) AS score
FROM f_keys a JOIN f_masks m ON m.block = a.block AND m.ord = a.ord
JOIN f_keys b ON b.block = a.block AND a.ord < b.ord
WHERE 200 * {lcs('a.n', 'm.masks', 'b.k')} >= 92 * (a.n + b.n)""")
block("f_lower", "SELECT block, dst, list(src) AS lower_ones FROM f_edges GROUP BY block, dst")
block("f_walk", """
SELECT DISTINCT block, 0::BIGINT AS ord, []::BIGINT[] AS kept FROM f_keys
UNION ALL
SELECT w.block, k.ord, CASE WHEN list_has_any(w.kept, coalesce(n.lower_ones, []::BIGINT[])) THEN w.kept
  ELSE list_append(w.kept, k.ord) END
FROM f_walk w JOIN f_keys k ON k.block = w.block AND k.ord = w.ord + 1
LEFT JOIN f_lower n ON n.block = k.block AND n.dst = k.ord""")
block("f_kept", """
SELECT block, unnest(kept) AS ord FROM f_walk
QUALIFY row_number() OVER (PARTITION BY block ORDER BY f_walk.ord DESC) = 1""")
block("f_kept_rows", """
SELECT k.row_id, k.block, k.ord FROM f_keys k JOIN f_kept s ON s.block = k.block AND s.ord = k.ord""")
block("r_clean", f"""
SELECT * FROM x_clean WHERE NOT ({NO_ID}) OR zip_code IS NULL
   OR row_id IN (SELECT row_id FROM f_kept_rows)""")



def key_of_row(row: str) -> str:
    return sorted_key(f"coalesce({row}.name, '') || ' ' || coalesce({row}.street_address, '')")


# each listing of a place beside the latest one
block("drift_rows", f"""
SELECT t.row_id, {key_of_row('t')} AS a, {key_of_row('p')} AS b
FROM l_typed t JOIN x_typed_place p ON p.place_id = t.place_id WHERE trim(t.place_id) <> ''""")
block("drift_keys", "SELECT DISTINCT a FROM drift_rows")
block("drift_masks", masks("drift_keys", "a", "a"))

# ------------------------------------------------------------------- enrichment

DAYS = " + ".join(f"contains(lower(opening_hours), '{d}')::INT" for d in "mon tue wed thu fri sat sun".split())


def enriched(source: str, name: str) -> None:
    block(name, f"""
SELECT *, has_facebook::INT + has_instagram::INT AS social_media_count,
  (has_website::INT + has_email::INT + has_phone::INT + has_facebook::INT + has_instagram::INT
   + has_booking_link::INT) / 6.0::DOUBLE AS digital_presence_score
FROM (SELECT *,
  {has('website')} AS has_website, {has('email_normalized')} OR {has('email')} AS has_email,
  {has('phone_normalized')} OR {has('phone')} AS has_phone, {has('facebook')} AS has_facebook,
  {has('instagram')} AS has_instagram, {has('booking_link')} AS has_booking_link, {has('description')} AS has_description,
  {has('main_image_url')} AS has_main_image,
  ({' + '.join(f'{has(c)}::INT' for c in 'name category street_address city zip_code phone email website description main_image_url'.split())}) / 10.0::DOUBLE AS completeness_score,
  CASE WHEN coalesce(trim(opening_hours), '') = '' THEN 0
       WHEN NOT json_valid(opening_hours) THEN {DAYS}
       WHEN json_type(json_hours) = 'OBJECT' THEN len(list_filter(json_extract(json_hours, '$.*'),
         lambda v: v::VARCHAR NOT IN ('null', '""', '0', '0.0', 'false', '[]', '{{}}')))
       WHEN json_type(json_hours) = 'ARRAY' THEN json_array_length(json_hours)
       ELSE 0 END::INT AS days_open_per_week,
  length(coalesce(description, ''))::INT AS description_length,
  CASE WHEN price IN ('unknown', '$', '$$', '$$$', '$$$$') THEN price ELSE 'unknown' END AS price_bucket,
  CASE WHEN coalesce(ratings, 0) <= -1 THEN NULL WHEN coalesce(ratings, 0) <= 0 THEN 'none'
       WHEN ratings <= 5 THEN 'very_low' WHEN ratings <= 20 THEN 'low'
       WHEN ratings <= 100 THEN 'moderate' ELSE 'high' END AS review_volume_tier
FROM (SELECT *, CASE WHEN json_valid(opening_hours) THEN opening_hours ELSE '{{}}' END::JSON AS json_hours FROM {source}))""")


enriched("l_clean", "e_clean")
enriched("r_clean", "e_resolved")

# ------------------------------------------------------- requests and responses


def key_of(model: str, system: str) -> str:
    return f"sha256({quoted(model + '::' + system + '::')} || prompt)"


def category_requests(source: str, name: str) -> None:
    options = "".join(f"\n- {label}" for label in S.taxonomy)
    block(f"{name}_distinct", f"""
SELECT category_normalized, coalesce(description, '') AS snippet, n_rows
FROM (SELECT *, count(*) OVER (PARTITION BY category_normalized) AS n_rows FROM {source}
      WHERE category_normalized IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY category_normalized ORDER BY {PROCESSING}) = 1""")
    block(name, f"""
SELECT *, {key_of(S.bulk_model, prompts.CATEGORY_SYSTEM)} AS key FROM (
  SELECT category_normalized, snippet, 'Category as listed: ' || category_normalized
    || CASE WHEN snippet <> '' THEN {quoted(chr(10) + 'Description: ')} || snippet ELSE '' END
    || {quoted(f'{chr(10)}{chr(10)}Labels:{options}{chr(10)}{chr(10)}Which label fits best?')} AS prompt
  FROM {name}_distinct)""")


def replies(name: str) -> None:
    """Requests with their reply, empty where the answer failed."""
    block(f"{name}_replies", f"""
SELECT q.*, CASE WHEN a.status = 'succeeded' THEN a.text ELSE '' END AS reply
FROM {name} q JOIN ({REPLY_SQL.format(requests=name)}) a ON a.key = q.key""")


TAXONOMY_LIST = ", ".join(quoted(t) for t in S.taxonomy)


def guard(reply: str) -> str:
    return f"CASE WHEN trim({reply}) IN ({TAXONOMY_LIST}) THEN trim({reply}) ELSE {quoted(S.fallback_label)} END"


for source, name in (("e_clean", "cat_clean"), ("e_resolved", "cat_resolved")):
    category_requests(source, name)
    replies(name)

# --------------------------------------------------------------------- segments

TIER_NUMBER = """CASE review_volume_tier WHEN 'none' THEN 0 WHEN 'very_low' THEN 1 WHEN 'low' THEN 2
  WHEN 'moderate' THEN 3 ELSE 4 END::BIGINT"""

block("s_clean", f"SELECT *, {TIER_NUMBER} AS cluster_id, category_normalized AS category_llm FROM e_clean")
block("s_resolved", f"""
SELECT e.*, {TIER_NUMBER} AS cluster_id, coalesce({guard('c.reply')}, {quoted(S.fallback_label)}) AS category_llm
FROM e_resolved e LEFT JOIN cat_resolved_replies c ON c.category_normalized = e.category_normalized""")


def stat_text() -> str:
    names = ["size", "pct_of_total", *(f"avg_{f}" for f in S.numeric_features), "top_category"]
    return " || chr(10) || ".join(
        f"'- {n}: ' || coalesce(CAST({n} AS VARCHAR), 'none')" for n in names
    )


def segments(source: str, name: str) -> None:
    averages = ", ".join(f"{settle(f'avg({f})', 3)} AS avg_{f}" for f in S.numeric_features)
    block(f"{name}_stats", f"""
SELECT a.*, m.category_llm AS top_category FROM (
  SELECT cluster_id, count(*) AS size, {settle(f'100.0::DOUBLE * count(*) / (SELECT count(*) FROM {source})', 2)} AS pct_of_total,
    {averages} FROM {source} GROUP BY cluster_id) a
LEFT JOIN (SELECT cluster_id, category_llm FROM {source} WHERE category_llm IS NOT NULL
  GROUP BY cluster_id, category_llm
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, category_llm) = 1) m
ON m.cluster_id = a.cluster_id""")
    block(f"{name}_samples", f"""
SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY md5('{S.seed}:' || row_id), row_id) AS sample_no
FROM {source} QUALIFY sample_no <= 5""")
    block(f"{name}_ask", f"""
SELECT *, {key_of(S.reasoning_model, prompts.SEGMENT_SYSTEM)} AS key FROM (
  SELECT cluster_id, 'Segment ' || cluster_id || chr(10) || {stat_text()} || chr(10) || chr(10) || 'Members:'
    || chr(10) || members || chr(10) || chr(10) || 'Name and describe the segment.' AS prompt
  FROM {name}_stats JOIN (
    SELECT cluster_id, string_agg(sample_no || '. ' || coalesce(name, '?') || ' | category: '
      || coalesce(category_llm, category_normalized, 'none') || ' | description: '
      || coalesce(description, ''), chr(10) ORDER BY sample_no) AS members
    FROM {name}_samples GROUP BY cluster_id) USING (cluster_id))""")
    replies(f"{name}_ask")
    ok = "json_valid(reply) AND json_type(js) = 'OBJECT'"
    block(f"{name}_labels", f"""
SELECT cluster_id,
  CASE WHEN usable THEN js->>'$.segment_name' ELSE 'Segment ' || cluster_id END AS segment_name,
  CASE WHEN usable THEN js->>'$.segment_description' ELSE reply END AS segment_description
FROM (SELECT *, {ok} AND js->>'$.segment_name' IS NOT NULL AND js->>'$.segment_description' IS NOT NULL AS usable
  FROM (SELECT *, CASE WHEN json_valid(reply) THEN reply ELSE '0' END::JSON AS js FROM {name}_ask_replies))""")
    block(f"{name}_brief", f"""
SELECT *, {key_of(S.reasoning_model, prompts.BRIEF_SYSTEM)} AS key FROM (
  SELECT cluster_id, 'Segment: ' || segment_name || chr(10) || 'About: ' || segment_description || chr(10)
    || {stat_text()} || chr(10) || chr(10) || 'Write the brief.' AS prompt
  FROM {name}_stats JOIN {name}_labels USING (cluster_id))""")
    replies(f"{name}_brief")
    block(f"{name}_briefs", f"""
SELECT cluster_id,
  CASE WHEN {ok} THEN js->>'$.priority_tier' ELSE 'Unknown' END AS priority_tier,
  CASE WHEN {ok} THEN array_to_string(CAST(js->'$.key_gaps' AS VARCHAR[]), ', ') ELSE '' END AS key_gaps,
  CASE WHEN {ok} THEN js->>'$.recommended_approach' ELSE reply END AS recommended_approach,
  CASE WHEN {ok} THEN js->>'$.estimated_deal_rationale' ELSE '' END AS estimated_deal_rationale
FROM (SELECT *, CASE WHEN json_valid(reply) THEN reply ELSE '0' END::JSON AS js FROM {name}_brief_replies)""")


segments("s_clean", "g_clean")
segments("s_resolved", "g_resolved")

# ------------------------------------------------------------------- embeddings

block("v_cells", """
SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS dim FROM embeddings""")
block("v_centers", """
SELECT label AS cluster_id, list(value ORDER BY dim) AS centroid
FROM (SELECT label, dim, avg(value) AS value FROM v_cells GROUP BY label, dim) GROUP BY label""")
block("v_nearest", """
SELECT vec_id, cluster_id, d * d AS distance2 FROM (
  SELECT vec_id, cluster_id, list_distance(embedding::DOUBLE[], centroid) AS d FROM embeddings, v_centers)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster_id) = 1""")
