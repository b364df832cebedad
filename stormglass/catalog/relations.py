"""The derived inputs and intermediate results in DuckDB SQL, as named relations.

Independent of the Spark code: the check compares both on the same Parquet tables.
"""

from __future__ import annotations

import re


def _words(slug: str) -> str:
    spaced = rf"regexp_replace(replace(replace({slug}, '-', ' '), '_', ' '), '\d+', '', 'g')"
    return (
        f"array_to_string(list_transform(list_filter(str_split({spaced}, ' '), "
        "lambda w: length(w) > 2), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def archive_title(url: str) -> str:
    slug = f"split_part(split_part(str_split(rtrim({url}, '/'), '/')[-1], '.', 1), '?', 1)"
    words = _words(slug)
    return f"CASE WHEN length({words}) > 15 THEN {words} END"


def live_title(url: str) -> str:
    slug = f"replace(replace(split_part(str_split(rtrim({url}, '/'), '/')[-1], '.', 1), '-', ' '), '_', ' ')"
    runs = rf"regexp_extract_all({slug}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    title = f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"
    return f"left(coalesce(nullif({title}, ''), {url}), 60)"


# --- Fixed values of the checks: words, patterns and classes, as in fixed_values.py, in their order.
BATCH_CATEGORY = """CASE
  WHEN regexp_matches(themes, 'MILITARY|WAR|WEAPON|MISSILE|INVASION|AIRSTRIKE') THEN 'CONFLICT'
  WHEN regexp_matches(themes, 'SANCTION|EMBARGO|TARIFF|EXPORT_CONTROL') THEN 'ECONOMIC_PRESSURE'
  WHEN regexp_matches(themes, 'COUP|PROTEST|RIOT') THEN 'POLITICAL_INSTABILITY'
  WHEN regexp_matches(themes, 'DIPLOMATIC|EXPULSION') THEN 'DIPLOMATIC_TENSION'
  WHEN regexp_matches(themes, 'CEASEFIRE') THEN 'DEESCALATION'
  WHEN regexp_matches(themes, 'ESPIONAGE|CYBERATTACK') THEN 'INTELLIGENCE_CYBER'
  WHEN regexp_matches(themes, 'NUCLEAR|BLOCKADE|ANNEXATION') THEN 'SPECIAL' END"""

LIVE_CATEGORY = """CASE
  WHEN regexp_matches(themes, 'MILITARY|WAR|WEAPON|MISSILE|INVASION') THEN 'Military'
  WHEN regexp_matches(themes, 'SANCTION|EMBARGO|TARIFF') THEN 'Sanctions'
  WHEN regexp_matches(themes, 'DIPLOMATIC|EXPULSION') THEN 'Diplomatic'
  WHEN regexp_matches(themes, 'NUCLEAR') THEN 'Nuclear'
  WHEN regexp_matches(themes, 'COUP|PROTEST') THEN 'Political' ELSE 'Other' END"""

LIVE_THEMES = (
    "regexp_matches(themes, '(?i)MILITARY|WAR|WEAPON|MISSILE|SANCTION|EMBARGO|COUP|PROTEST|"
    "DIPLOMATIC|NUCLEAR|CYBERATTACK')"
)
LIVE_URL = (
    "regexp_matches(lower(url), 'war|attack|sanction|missile|nuclear|military|conflict|invasion|"
    "protest|coup|strike|troops|weapon|crisis|threat|bomb|terror|drone|ceasefire|diplomacy|nato|"
    "un |iran|russia|china|israel|ukraine|gaza|korea')"
)
LIVE_TITLE_OK = r"""length(title) > 20 AND contains(title, ' ')
  AND NOT regexp_matches(title, '^[A-Fa-f0-9\s]+$')
  AND NOT regexp_matches(title, '^[A-Z][a-z]* \d+$')
  AND length(regexp_replace(title, '[^a-zA-Z]', '', 'g')) > 10"""
CLEAN_TITLE = r"""NOT regexp_matches(title, '#|\.com|\.org|\.net')
  AND NOT regexp_matches(title, '[A-Fa-f0-9]{6,}') AND contains(title, ' ')
  AND length(regexp_replace(title, '[^a-zA-Z]', '', 'g')) > 15"""
FEED_TITLE_OK = rf"length(regexp_replace(title, '[\d\s]', '', 'g')) > 5 AND {CLEAN_TITLE}"
ARCHIVE_TITLE_OK = (
    rf"length(title) > 20 AND {CLEAN_TITLE} "
    "AND NOT regexp_matches(title, '^Article [A-Z][a-z]+ [A-Z][a-z]+')"
)


def relevant(title: str, label: str) -> str:
    nouns = (
        f"list_filter(list_transform(regexp_extract_all({label}, '[A-Z][a-z]+'), lambda w: lower(w)), "
        "lambda w: w NOT IN ('war', 'tensions', 'protests', 'crisis', 'escalation', 'airstrikes', "
        "'peak', 'ceasefire', 'civil', 'political', 'geopolitical', 'border', 'strait'))"
    )
    conflict = (
        f"regexp_matches(lower({title}), 'attack|missile|strike|military|troops|invasion|bomb|nuclear|"
        "riot|clash|conflict|threat|shoot|kill|dead|wound|protest|warn|launch')"
    )
    hits = f"len(list_filter({nouns}, lambda w: contains(lower({title}), w)))"
    return f"(len({nouns}) = 0 OR ({hits} > 0 AND {conflict}))"


RELATIONS: dict[str, str] = {
    "news_rows": f"""
      SELECT *, {BATCH_CATEGORY} AS category FROM (
        SELECT CAST(o_orderkey AS VARCHAR) AS record_id,
          CASE WHEN o_orderkey % 107 = 0 THEN '2022'
               ELSE strftime(o_orderdate, '%Y%m%d') || '120000' END AS date,
          'src' || (o_custkey % 20) || '.example' AS source,
          'https://news.example/a/' || ['military-strike-near-border-town',
            'sanction_talks_resume_in_capital', 'short', 'protest-threat-grows-in-decade'
            ][o_orderkey % 4 + 1] || '-' || o_orderkey || '.html' AS url,
          ['MILITARY', 'SANCTION', 'PROTEST', 'DIPLOMATIC', 'CEASEFIRE', 'CYBERATTACK', 'NUCLEAR',
           'SPORTS'][o_orderkey % 8 + 1] || '#3##1#X#'
            || ['US', 'RS', 'UP', 'IR', 'IS'][c_nationkey % 5 + 1] || '#' AS themes,
          CASE WHEN o_orderkey % 101 = 0 THEN 'bad' WHEN o_orderkey % 103 = 0 THEN '0,1,99.00,0'
               ELSE '0,1,' || (neg // 100) || '.' || lpad(CAST(neg % 100 AS VARCHAR), 2, '0') || ',0'
               END AS tone
        FROM (SELECT *, 500 + CAST(round(o_totalprice * 100) AS BIGINT) % 500
                + CASE WHEN date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 61 = 0
                       THEN 3500 ELSE 0 END AS neg
              FROM orders JOIN customer ON o_custkey = c_custkey))""",
    "news": "SELECT * FROM news_rows WHERE category IS NOT NULL",
    # Fixed values of the checks: theme codes, countries and slugs, as in sources/derived.py.
    "theme_lists": """
      SELECT CAST(o_orderkey AS VARCHAR) AS record_id,
        CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN '' ELSE
          codes[o_orderkey % len(codes) + 1] || ';' || codes[(o_orderkey * 7 + o_custkey) % len(codes) + 1] || ';' ||
          codes[o_custkey % len(codes) + 1] || ';1#X#' || countries[o_orderkey % 5 + 1] || '#;4#Y#' || countries[o_custkey % 5 + 1] || '#'
          END AS themes,
        'https://news.example/' || slugs[o_orderkey % len(slugs) + 1] || CASE WHEN o_orderkey % 3 = 0 THEN '/' ELSE '.html' END AS url
      FROM orders, (SELECT
        ['MILITARY', 'AWARD', 'TAX_FNCACT_AUTHOR', 'SOFTWARE', 'EDUCATION', 'SANCTION', 'UNGP_FORESTS', 'COUP', 'diplomatic',
         'EXPORT_CONTROL', 'WB_507_WATER', 'NUCLEAR', 'CEASEFIRE', 'ESPIONAGE', 'EXPULSION', 'AIRSTRIKE', 'RIOTOUS', 'LEADER', 'war'] AS codes,
        ['US', 'RS', 'UP', 'IR', 'IS'] AS countries,
        ['military-strike-near-border-town', 'sanction_talks_resume_in_capital', 'short', 'protest-threat-grows-in-decade',
         'article-about-news-from-the-town', 'deadbeef0011-report-on-border-talks', 'bad-cafe-dead-beef-face-decade',
         'story-20240101123456789', 'nospaceinthisveryveryverylongslug', 'visit-site#now-for-more-border-news',
         '1234-5678-9012-3456-7890-12', 'a-b-c-d-e-f-g-h-i-j-k-l-m-n', 'troops-cross-the-river-in-the-north?page=2',
         'un-of-it-crisis-in-gaza-strip-today'] AS slugs)""",
    "dated": """
      SELECT * EXCLUDE (d) REPLACE (d AS date) FROM (
        SELECT *, CASE WHEN length(date) >= 8
          THEN CAST(try_strptime(substr(date, 1, 8), '%Y%m%d') AS DATE) END AS d FROM news)
      WHERE d IS NOT NULL""",
    "scored": """
      SELECT * FROM (SELECT *, TRY_CAST(str_split(tone, ',')[3] AS DOUBLE) AS neg_score FROM dated)
      WHERE neg_score BETWEEN 0 AND 50""",
    "clean": "SELECT * FROM scored WHERE regexp_matches(themes, '#(U[A-RT-Z]|[A-TV-Z][A-Z])#')",
    "daily": """
      SELECT date, count(*) AS total_events, avg(neg_score) AS avg_negative_tone,
        avg(neg_score) * ln(count(*) + 1) AS geo_tension_raw
      FROM clean GROUP BY date""",
    "cat_counts": "SELECT date, category, count(*) AS cat_count FROM clean GROUP BY date, category",
    "dominant": """
      SELECT date, category AS dominant_category FROM cat_counts
      QUALIFY row_number() OVER (PARTITION BY date ORDER BY cat_count DESC, category) = 1""",
    "percentiles": """
      SELECT quantile_cont(geo_tension_raw, 0.01) AS p1, quantile_cont(geo_tension_raw, 0.99) AS p99
      FROM daily""",
    "idx_full": """
      SELECT daily.*, dominant_category,
        CASE WHEN p99 <> p1
          THEN greatest(0.0, least(10.0, (geo_tension_raw - p1) / (p99 - p1) * 10)) END
          AS geo_tension_index
      FROM daily LEFT JOIN dominant USING (date) CROSS JOIN percentiles""",
    "idx": "SELECT date, geo_tension_index, total_events, dominant_category FROM idx_full",
    "with_threshold": """
      SELECT idx.*, year(date) AS year, avg(geo_tension_index) OVER y AS year_mean,
        stddev_samp(geo_tension_index) OVER y AS year_std,
        avg(geo_tension_index) OVER y + 3 * stddev_samp(geo_tension_index) OVER y AS threshold
      FROM idx WINDOW y AS (PARTITION BY year(date))""",
    "spikes": """
      SELECT date, geo_tension_index, total_events, threshold, true AS is_spike, dominant_category
      FROM with_threshold WHERE geo_tension_index > threshold""",
    "prices": """
      SELECT CAST(l_shipdate AS DATE) AS date, p_brand AS ticker,
        floor(sum(CAST(round(l_extendedprice * 100) AS BIGINT))::DOUBLE * 100.0
              / sum(CAST(l_quantity AS BIGINT))::DOUBLE + 0.5) / 10000.0 AS close
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "windowed": """
      SELECT s.date AS spike_date, geo_tension_index, dominant_category, p.date AS price_date, ticker,
        close, CAST(date_diff('day', s.date, p.date) AS INTEGER) AS days_from_spike
      FROM prices p JOIN spikes s ON date_diff('day', s.date, p.date) BETWEEN -30 AND 30""",
    "based": """
      SELECT w.*, b.close AS close_day0, (w.close - b.close) / nullif(b.close, 0) * 100 AS return_pct
      FROM windowed w JOIN windowed b ON w.spike_date = b.spike_date AND w.ticker = b.ticker
        AND b.days_from_spike = 0""",
    "by_spike": """
      SELECT spike_date, dominant_category, ticker, days_from_spike,
        avg(return_pct) AS avg_return_pct, count(*) AS num_obs
      FROM based GROUP BY ALL""",
    "curve": """
      SELECT ticker, days_from_spike, avg(return_pct) AS avg_return_pct, count(spike_date) AS num_events
      FROM based GROUP BY ALL""",
    "summary": """
      SELECT ticker, avg(return_pct) FILTER (days_from_spike = 5) AS avg_return_5d,
        avg(return_pct) FILTER (days_from_spike = 30) AS avg_return_30d,
        min(return_pct) AS worst_drawdown, count(spike_date) AS num_events
      FROM based GROUP BY ticker""",
    "portfolio": """
      SELECT * FROM (VALUES ('Brand#1', 30.0::DOUBLE), ('Brand#10', 50.0::DOUBLE),
        ('Brand#11', 20.0::DOUBLE)) t(ticker, weight)""",
    "portfolio_unknown": """
      SELECT * FROM (VALUES ('Brand#1', 30.0::DOUBLE), ('Brand#10', 50.0::DOUBLE),
        ('Brand#X', 20.0::DOUBLE)) t(ticker, weight)""",
    "holdings": "SELECT * FROM portfolio LEFT JOIN summary USING (ticker)",
    "holdings_unknown": "SELECT * FROM portfolio_unknown LEFT JOIN summary USING (ticker)",
    "exposure": """
      SELECT ticker, weight, avg_return_5d, worst_drawdown, abs(worst_drawdown) * weight / 100
        AS exposure_score FROM holdings""",
    "sectors": """
      SELECT ['Defense', 'Energy', 'Gold/Safe Haven', 'Tech', 'Semiconductors', 'Airlines'
             ][(pos - 1) % 6 + 1] AS sector, ticker
      FROM (SELECT p_brand AS ticker, row_number() OVER (ORDER BY p_brand) AS pos
            FROM (SELECT DISTINCT p_brand FROM part)) WHERE pos <= 21""",
    "vix": """
      SELECT date, floor(sum(c)::DOUBLE / count(*)::DOUBLE / 100.0 + 0.5) / 10000.0 AS vix FROM (
        SELECT CAST(o_orderdate AS DATE) AS date, CAST(round(o_totalprice * 100) AS BIGINT) AS c
        FROM orders) WHERE isodow(date) <= 5 GROUP BY date""",
    "articles": """
      SELECT source AS domain, url, themes, category, CAST(substr(date, 1, 8) AS VARCHAR) AS day_text,
        CAST(try_strptime(substr(date, 1, 8), '%Y%m%d') AS DATE) AS article_date, date AS datetime
      FROM news WHERE url IS NOT NULL AND date IS NOT NULL
        AND try_strptime(substr(date, 1, 8), '%Y%m%d') IS NOT NULL""",
    "news_joined": """
      SELECT s.date AS spike_date, dominant_category, article_date, domain, url, themes,
        CAST(date_diff('day', s.date, article_date) AS INTEGER) AS days_from_spike
      FROM articles a JOIN spikes s ON date_diff('day', s.date, article_date) BETWEEN -3 AND 3""",
    "titled": f"""
      SELECT * FROM (SELECT *, {archive_title('url')} AS title FROM news_joined)
      WHERE title IS NOT NULL""",
    "spike_news": """
      SELECT * FROM titled QUALIFY row_number() OVER (
        PARTITION BY spike_date ORDER BY days_from_spike, url, domain, themes) <= 50""",
    "labels": """
      SELECT date, ['Iran War', 'Hong Kong Protests Peak', 'Geopolitical Event'
        ][(date_diff('day', DATE '1995-01-01', date) % 9) // 3 + 1] AS label
      FROM spikes WHERE date_diff('day', DATE '1995-01-01', date) % 3 = 0""",
    "around": """
      SELECT n.* EXCLUDE (days_from_spike), s.date AS event_date,
        CAST(date_diff('day', s.date, article_date) AS INTEGER) AS days_from_event
      FROM spike_news n JOIN spikes s ON abs(date_diff('day', s.date, article_date)) <= 3""",
    "word_counts": """
      SELECT event_date, word, count(*) AS n FROM (
        SELECT event_date, unnest(regexp_extract_all(lower(title), '[a-z]{4,}')) AS word FROM around)
      WHERE word NOT IN ('the', 'and', 'for', 'are', 'was', 'has', 'had', 'with', 'that', 'this',
        'from', 'have', 'been', 'will', 'its', 'not', 'but', 'they', 'their', 'said', 'says', 'over',
        'after', 'more', 'also', 'than', 'into', 'about')
      GROUP BY event_date, word""",
    "auto_labels": """
      SELECT event_date AS date, string_agg(upper(word[1]) || word[2:], ' · ' ORDER BY n DESC, word)
        AS auto_label
      FROM (SELECT * FROM word_counts
            QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY n DESC, word) <= 3)
      GROUP BY event_date""",
    "labelled": """
      SELECT spikes.*, coalesce(label, auto_label, 'Geopolitical Event') AS label
      FROM spikes LEFT JOIN labels USING (date) LEFT JOIN auto_labels USING (date)""",
    "matched": """
      SELECT date, arg_min(have, abs(date_diff('day', date, have)) * 2
          + CASE WHEN have > date THEN 1 ELSE 0 END) AS nearest_date
      FROM (SELECT DISTINCT date FROM spikes)
        CROSS JOIN (SELECT DISTINCT spike_date AS have FROM by_spike) GROUP BY date""",
    "mapped": "SELECT by_spike.*, sector FROM by_spike JOIN sectors USING (ticker)",
    "offsets": """
      SELECT spike_date, arg_min(days_from_spike, abs(days_from_spike - 5) * 2
          + CASE WHEN days_from_spike > 5 THEN 1 ELSE 0 END) AS target_offset
      FROM mapped WHERE days_from_spike > 0 GROUP BY spike_date""",
    "by_sector": """
      SELECT spike_date, target_offset, sector, avg(avg_return_pct) AS avg_return_pct
      FROM mapped JOIN offsets USING (spike_date) WHERE days_from_spike = target_offset GROUP BY ALL""",
    "live_raw": """
      SELECT CASE WHEN event_id % 97 = 0 THEN 'soon' ELSE strftime(ts, '%Y%m%d%H%M%S') END AS date,
        'src' || (user_id % 20) AS source,
        'https://live.example/' || ['military-strike-near-border-town',
          'sanction_talks_resume_in_capital', 'short', 'protest-threat-grows-in-decade'
          ][event_id % 4 + 1] || '-' || event_id || '.html' AS url,
        CASE event_type WHEN 'click' THEN 'MILITARY' WHEN 'view' THEN 'SANCTION'
          WHEN 'purchase' THEN 'diplomatic' WHEN 'signup' THEN 'PROTEST' ELSE 'SPORTS' END AS themes,
        '0,1,' || (t // 100) || '.' || lpad(CAST(t % 100 AS VARCHAR), 2, '0') || ',0' AS tone
      FROM (SELECT *, abs(CAST(round(value * 100) AS BIGINT)) % 5000 AS t FROM events
        UNION ALL SELECT *, (abs(CAST(round(value * 100) AS BIGINT)) + 700) % 5000 AS t FROM events
          WHERE event_id % 41 = 0)""",
    "live_once": """
      SELECT * FROM live_raw
      QUALIFY row_number() OVER (PARTITION BY url, date ORDER BY source, themes, tone) = 1""",
    "live_titled": f"SELECT *, {live_title('url')} AS title FROM live_raw",
    "once_titled": f"SELECT *, {live_title('url')} AS title FROM live_once",
    "live_articles": f"""
      SELECT *, {LIVE_CATEGORY} AS category, try_strptime(date, '%Y%m%d%H%M%S') AS time
      FROM once_titled
      WHERE {LIVE_THEMES} AND {LIVE_URL} AND {LIVE_TITLE_OK}
        AND try_strptime(date, '%Y%m%d%H%M%S') IS NOT NULL""",
    "readings": f"""
      SELECT timestamp, total_events,
        CASE WHEN p99 <> p1 THEN greatest(0.0, least(10.0, (raw - p1) / (p99 - p1) * 10)) END
          AS tension_score
      FROM (SELECT time_bucket(INTERVAL 15 MINUTE, t) AS timestamp, count(*) AS total_events,
              avg(neg) * ln(count(*) + 1) AS raw
            FROM (SELECT try_strptime(date, '%Y%m%d%H%M%S') AS t,
                    TRY_CAST(str_split(tone, ',')[3] AS DOUBLE) AS neg, themes FROM live_once)
            WHERE t IS NOT NULL AND neg BETWEEN 0 AND 50 AND {LIVE_THEMES} GROUP BY 1)
        CROSS JOIN percentiles""",
}


def with_relations(select: str) -> str:
    """The statement with every relation it needs, in order of dependence."""
    needed: list[str] = []

    def visit(sql: str, owner: str | None) -> None:
        for name in RELATIONS:
            if name != owner and re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
                if name not in needed:
                    visit(RELATIONS[name], name)
                    needed.append(name)

    visit(select, None)
    if not needed:
        return select.strip()
    parts = ",\n".join(f"{n} AS MATERIALIZED ({RELATIONS[n].strip()})" for n in needed)
    return f"WITH {parts}\n{select.strip()}"
