"""SQL of the training-data queries, for DuckDB."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op1_mix_sources"] = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
    FROM documents
), summed AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
        source_size * 2.0::DOUBLE AS most
    FROM summed
), placed AS (
    SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place FROM weighted
), levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
        - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM placed
), shared AS (
    SELECT *, (SELECT arg_min(level, place) FROM levels WHERE level * weight <= most) AS common FROM levels
), targets AS (
    SELECT *, least(most, coalesce(common * weight, most)) AS target FROM shared
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
)
SELECT d.doc_id, d.size, r.source_size, r.target,
    CAST(d.size * (floor(r.rate) + CASE WHEN
        ('0x' || substr(sha256('mix-0:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT
        / 4503599627370496.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
"""


def _posterior(name: str, parent: str, groups: str, above: str) -> str:
    """The posterior of one level: its estimated strength, then its groups below their parents' means."""
    return f"""
{name}_totals AS (
    SELECT sum(pages)::DOUBLE AS n, sum(bad)::DOUBLE AS x, count(*) AS k, sum(bad * bad / pages) AS squares,
        sum(pages::DOUBLE * pages) AS sizes, x / n AS rate, rate * (1 - rate) AS spread
    FROM {groups}
), {name}_share AS (
    SELECT CASE WHEN spread * (n - sizes / n - (k - 1)) > 0
        THEN (squares - x * rate - spread * (k - 1)) / (spread * (n - sizes / n - (k - 1))) END AS share
    FROM {name}_totals
), {name}_post AS (
    SELECT g.*, greatest(1.0, least(1000.0, CASE WHEN share > 0 THEN 1 / share - 1 ELSE 1000.0 END)) AS strength,
        strength + pages AS weight, (strength * a.mean + bad) / (strength + pages) AS mean
    FROM (SELECT * FROM {groups}) g JOIN (SELECT {parent}, mean FROM {above}) a USING ({parent}), {name}_share
)"""


ORACLES["op5_judge_urls"] = f"""
WITH parsed AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), named AS (
    SELECT *, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name, string_split(name, '.') AS labels,
        array_to_string(labels[-2:], '.') AS two,
        two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'co.nz', 'com.br', 'co.in') AS long,
        regexp_matches(name, '^[0-9.]+$') OR contains(name, '[') AS numbers,
        CASE WHEN numbers THEN name WHEN long THEN two ELSE labels[-1] END AS suffix,
        CASE WHEN numbers THEN name WHEN long THEN array_to_string(labels[-3:], '.') ELSE two END AS domain
    FROM parsed
), outcomes AS (
    SELECT doc_id, CASE WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN greatest(1 - quality, toxic) END AS bad
    FROM labels
), hosts AS (
    SELECT host, domain, suffix, 1 AS everything, count(*) AS pages, sum(bad)::DOUBLE AS bad
    FROM named JOIN outcomes ON page_id = doc_id WHERE bad IS NOT NULL GROUP BY ALL
), domains AS (
    SELECT domain, suffix, 1 AS everything, sum(pages) AS pages, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (
    SELECT suffix, 1 AS everything, sum(pages) AS pages, sum(bad) AS bad FROM hosts GROUP BY ALL
), top AS (
    SELECT 1 AS everything, coalesce(sum(pages), 0) + 2.0 AS weight, (coalesce(sum(bad), 0) + 0.2) / weight AS mean
    FROM hosts
), {_posterior("suffix", "everything", "suffixes", "top")}, {_posterior("domain", "suffix", "domains", "suffix_post")},
{_posterior("host", "domain", "hosts", "domain_post")}, met AS (
    SELECT n.*, coalesce(h.mean, d.mean, s.mean, t.mean) AS mean, coalesce(h.weight, d.weight, s.weight, t.weight) AS weight,
        CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (n.host = 'org' OR n.host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (n.host = 'net' OR n.host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM named n LEFT JOIN host_post h USING (host) LEFT JOIN domain_post d ON n.domain = d.domain
    LEFT JOIN suffix_post s ON n.suffix = s.suffix CROSS JOIN top t
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow' WHEN mean - 1.64 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM met
"""


# Escaping lengthens each & by 4, each < by 3 and each [ by 4 code points; a turn has 16 besides its role.
ORACLES["op9_format_chats"] = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), each AS (
    SELECT *, length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lbr;')) + 16 AS chars FROM said
), whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM each GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""


def _listed(source: str, key: str) -> str:
    return f"""
    SELECT {key}, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words, row_number() OVER () AS place
    FROM {source}"""


# Every window of a length that some item has, of documents and items, compared as texts.
ORACLES["op2_decontaminate"] = f"""
WITH docs AS ({_listed("documents", "doc_id")}), items AS ({_listed("benchmark", "item_id")}),
item_windows AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS i,
        array_to_string(words[i : i + size - 1], ' ') AS shown
    FROM items WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM item_windows
), doc_windows AS (
    SELECT place, size, unnest(range(1, len(words) - size + 2)) AS i, array_to_string(words[i : i + size - 1], ' ') AS shown
    FROM docs JOIN sizes ON len(words) >= size
), hits AS (
    SELECT place, i, d.size, item_id FROM doc_windows d JOIN (SELECT DISTINCT item_id, size, shown FROM item_windows) w
    ON d.size = w.size AND d.shown = w.shown
), covered AS (
    SELECT place, count(DISTINCT word) AS n_hit FROM (SELECT place, unnest(range(i, i + size)) AS word FROM hits) GROUP BY place
), named AS (
    SELECT place, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed
    FROM hits GROUP BY place
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (place) LEFT JOIN named USING (place)
"""


# The scores of all anchors with all rows, then the ranks by window functions.
ORACLES["op12_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS place,
        list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 256) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.place AS anchor, a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
        CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable a JOIN usable r ON a.place <> r.place WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS nth FROM scored WHERE same
    QUALIFY nth <= 5
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY n.score DESC, n.vec_id) AS turn
    FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
        AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
    QUALIFY turn <= 3
)
SELECT anchor_id, positive_id, CAST(turn AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives
"""


def _vote(place: int, bad: str, good: str) -> str:
    return f"(CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END) * {3**place}"


def _low_is_good(place: int, count: str, good: float, bad: float, of: str = "n_words") -> str:
    share = f"{count}::DOUBLE / nullif({of}, 0)"
    return _vote(place, f"{share} > {bad}", f"{share} < {good}")


_VOTES = " + ".join(
    [
        _vote(0, "n_words < 50", "n_words BETWEEN 100 AND 100000"),
        _vote(
            1,
            "word_chars::DOUBLE / nullif(n_words, 0) < 2 OR word_chars::DOUBLE / nullif(n_words, 0) > 15",
            "word_chars::DOUBLE / nullif(n_words, 0) BETWEEN 3 AND 10",
        ),
        _low_is_good(2, "n_symbols", 0.02, 0.1),
        _low_is_good(3, "n_dup_lines", 0.1, 0.6, of="n_lines"),
        _low_is_good(4, "n_repeat_words", 0.2, 0.4),
        _low_is_good(5, "n_capitals", 0.1, 0.4),
        _low_is_good(6, "n_marks", 0.02, 0.1),
        _low_is_good(7, "n_separators", 0.02, 0.1),
        _low_is_good(8, "n_endings", 0.05, 0.2),
    ]
)

_CAPITALS = r"\p{Lu}{2,}"
_COUNT = "CAST(len(regexp_extract_all(t, '{}')) AS BIGINT)".format

# Rounds of expectation-maximisation as a recursive table: a row per pattern and rule, with the model beside it.
ORACLES["op11_quality_rules"] = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, row_number() OVER () AS place, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '{WORD}')) AS lines
    FROM documents
), windows AS (
    SELECT place, unnest(range(1, len(words) - 1)) AS i, array_to_string(words[i : i + 2], ' ') AS gram FROM docs WHERE len(words) > 2
), repeated AS (
    SELECT place, count(DISTINCT word) AS n FROM (
        SELECT place, unnest([i, i + 1, i + 2]) AS word FROM (SELECT *, count(*) OVER (PARTITION BY place, gram) AS seen FROM windows) WHERE seen > 1
    ) GROUP BY place
), counted AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        {_COUNT("[#*$%&|<>]")} AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, {_COUNT(_CAPITALS)} AS n_capitals,
        {_COUNT("[.!?]{2,}")} AS n_marks,
        len(list_filter(words, lambda w: NOT regexp_matches(w, '[\\p{{L}}\\p{{N}}]'))) AS n_separators,
        len(list_filter(words, lambda w: regexp_matches(w, '[^\\p{{L}}\\p{{N}}.,;:!?''")\\]]$'))) AS n_endings
    FROM docs LEFT JOIN repeated USING (place)
), voted AS (
    SELECT *, {_VOTES} AS pattern FROM counted
), patterns AS (
    SELECT pattern, count(*)::DOUBLE AS n FROM voted GROUP BY pattern
), votes AS (
    SELECT pattern, n, rule, (pattern // CAST(pow(3, rule) AS BIGINT)) % 3 AS vote FROM patterns, range(9) r(rule)
), em AS (
    SELECT 0 AS round, rule, 0.8::DOUBLE AS share, 0.995::DOUBLE AS on_good, 0.3::DOUBLE AS on_bad FROM range(9) r(rule)
    UNION ALL
    SELECT round + 1, rule, (sum(n * p) OVER () / 9 + 1) / (sum(n) OVER () / 9 + 2), g, greatest(b, 1 - g)
    FROM (
        SELECT any_value(round) AS round, rule, sum(n) AS n, sum(n * p) / sum(n) AS p,
            (sum(n * p * (vote = 2)::INT) + 1) / (sum(n * p * (vote <> 1)::INT) + 2) AS g,
            (sum(n * (1 - p) * (vote = 0)::INT) + 1) / (sum(n * (1 - p) * (vote <> 1)::INT) + 2) AS b
        FROM (
            SELECT v.*, round, 1 / (1 + exp(-(ln(share) - ln(1 - share) + sum(CASE vote
                WHEN 2 THEN ln(on_good) - ln(1 - on_bad) WHEN 0 THEN ln(1 - on_good) - ln(on_bad) ELSE 0 END)
                OVER (PARTITION BY pattern)))) AS p
            FROM votes v JOIN em USING (rule) WHERE round < 30
        ) GROUP BY rule
    )
), qualities AS (
    SELECT pattern, 1 / (1 + exp(-(any_value(ln(share) - ln(1 - share)) + sum(CASE vote
        WHEN 2 THEN ln(on_good) - ln(1 - on_bad) WHEN 0 THEN ln(1 - on_good) - ln(on_bad) ELSE 0 END)))) AS quality
    FROM votes JOIN em USING (rule) WHERE round = 30 GROUP BY pattern
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM voted JOIN qualities USING (pattern)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND quality >= 0.5 AS kept
FROM judged
"""
