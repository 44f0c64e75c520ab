"""DuckDB twins of the registered queries (correctness oracle only).

The views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are registered by
the checker; ``event_log`` is the adapter, written once here as a CTE.
"""

from __future__ import annotations

from eventcraft.sources.event_log import event_log_sql

EL = "WITH " + event_log_sql("props")
ELB = "WITH " + event_log_sql("bad_rows")

# JSON pieces: only text that parses as JSON reaches the JSON functions.
J = "(CASE WHEN json_valid(udmap) THEN udmap END)"
OBJ = f"(coalesce(json_type({J}) = 'OBJECT', false))"


def jval(key: str) -> str:
    return f"(CASE WHEN {OBJ} THEN json_extract_string({J}, '$.{key}') END)"


CAL = """CAST(hour(epoch_ms(common_ts)) AS INTEGER) AS hour,
       CAST(isodow(epoch_ms(common_ts)) - 1 AS INTEGER) AS day_of_week,
       CAST(day(epoch_ms(common_ts)) AS INTEGER) AS day_of_month,
       CAST(month(epoch_ms(common_ts)) AS INTEGER) AS month"""

SQL: dict[str, str] = {}

SQL["stats_joined"] = f"""{ELB},
f AS (
  SELECT *, {CAL},
         CAST(hour(epoch_ms(common_ts)) // 6 AS INTEGER) AS time_period,
         CAST(isodow(epoch_ms(common_ts)) - 1 >= 5 AS INTEGER) AS is_weekend,
         coalesce(TRY_CAST({jval('botId')} AS INTEGER), -1) AS botId,
         coalesce(TRY_CAST({jval('pluginId')} AS INTEGER), -1) AS pluginId,
         CAST({OBJ} AS INTEGER) AS udmap_is_valid
  FROM event_log),
s AS (
  SELECT did, count(mid) AS mid_count, count(DISTINCT mid) AS mid_nunique,
         count(eid) AS eid_count, count(DISTINCT eid) AS eid_nunique,
         count(DISTINCT device_brand) AS device_brand_nunique,
         min(common_ts) AS common_ts_min, max(common_ts) AS common_ts_max
  FROM f GROUP BY did)
SELECT f.row_id, f.did, f.hour, f.day_of_week, f.day_of_month, f.month, f.time_period,
       f.is_weekend, f.botId, f.pluginId, f.udmap_is_valid, s.mid_count, s.mid_nunique,
       s.eid_count, s.eid_nunique, s.device_brand_nunique, s.common_ts_min, s.common_ts_max,
       round((s.common_ts_max - s.common_ts_min) / 1000.0, 6) AS ts_span
FROM f LEFT JOIN s USING (did)
"""

SQL["json_lenient"] = f"""{ELB}
SELECT row_id, {jval('botId')} AS botId, {jval('pluginId')} AS pluginId,
       CAST({OBJ} AS INTEGER) AS udmap_is_valid
FROM event_log
"""

SQL["calendar_features"] = f"""{EL}
SELECT row_id, {CAL}, CAST(year(epoch_ms(common_ts)) AS INTEGER) AS year,
       CAST(hour(epoch_ms(common_ts)) // 6 AS INTEGER) AS time_period,
       CAST(isodow(epoch_ms(common_ts)) - 1 >= 5 AS INTEGER) AS is_weekend
FROM event_log
"""

# --- scans, sinks, slicing ----------------------------------------------------------------

# An empty cell reads back as null, as the scripts' CSV reader does.
SQL["typed_scan"] = f"""{ELB}
SELECT row_id, did, mid, eid, device_brand, appver, channel, common_ts, nullif(udmap, '') AS udmap,
       is_new_did
FROM event_log
"""

_EL_COLS = ["row_id", "did", "mid", "eid", "device_brand", "ntt", "operator", "common_country",
            "common_province", "common_city", "appver", "channel", "os_type", "common_ts",
            "udmap", "is_new_did", "split"]
SQL["null_counts"] = ELB + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count "
    f"FROM event_log" for c in _EL_COLS)

SQL["label_counts"] = f"""{EL}
SELECT is_new_did, count(*) AS n FROM event_log GROUP BY is_new_did
"""

SQL["label_rate"] = f"""{EL}
SELECT round(avg(is_new_did), 6) AS label_rate FROM event_log
"""

SQL["first_rows"] = f"""{EL}
SELECT row_id, did, eid, common_ts FROM event_log ORDER BY row_id LIMIT 2000
"""

SQL["row_range_split"] = f"""{EL},
n AS (SELECT CAST(ceil(count(*) / 10.0) AS BIGINT) AS size FROM event_log),
i AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS idx FROM event_log)
SELECT row_id, 'train_' || lpad(CAST(idx // size + 1 AS VARCHAR), 2, '0') AS part_name
FROM i, n
"""

# --- JSON ---------------------------------------------------------------------------------

SQL["json_keys_text"] = f"""{ELB}
SELECT row_id,
       coalesce(CASE WHEN {OBJ} THEN array_to_string(list_sort(json_keys({J})), ' ') END, '')
         AS udmap_keys_str
FROM event_log
"""

SQL["json_flatten"] = f"""{ELB}
SELECT row_id, {jval('botId')} AS udmap_botId, {jval('pluginId')} AS udmap_pluginId
FROM event_log
"""

SQL["json_default"] = f"""{ELB}
SELECT row_id, coalesce({jval('botId')}, 'unknown_bot') AS botId,
       coalesce({jval('pluginId')}, 'unknown_plugin') AS pluginId
FROM event_log
"""

# --- device aggregates --------------------------------------------------------------------

SQL["device_stats"] = f"""{EL}
SELECT did, count(mid) AS mid_count, count(DISTINCT mid) AS mid_nunique,
       count(eid) AS eid_count, count(DISTINCT eid) AS eid_nunique,
       count(DISTINCT device_brand) AS device_brand_nunique,
       min(common_ts) AS common_ts_min, max(common_ts) AS common_ts_max,
       round((max(common_ts) - min(common_ts)) / 1000.0, 6) AS ts_span
FROM event_log GROUP BY did
"""

SQL["device_stats_union"] = f"""{EL},
u AS (SELECT did, mid, eid, common_ts FROM event_log WHERE split = 'train'
      UNION ALL
      SELECT did, mid, eid, common_ts FROM event_log WHERE split = 'test')
SELECT did, count(mid) AS mid_count, count(DISTINCT eid) AS eid_nunique,
       round((max(common_ts) - min(common_ts)) / 1000.0, 6) AS ts_span
FROM u GROUP BY did
"""

SQL["device_first_last"] = f"""{EL}
SELECT did, count(mid) AS mid_count, count(DISTINCT eid) AS eid_nunique,
       min(common_ts) AS common_ts_min, max(common_ts) AS common_ts_max,
       first(eid ORDER BY common_ts, row_id) AS first_eid,
       round((max(common_ts) - min(common_ts)) / 1000.0, 6) AS ts_span
FROM event_log GROUP BY did
"""

_USER = """count(*) AS user_total_events, count(DISTINCT mid) AS user_unique_mids,
       count(DISTINCT eid) AS user_unique_eids,
       count(DISTINCT device_brand) AS user_unique_device_brands,
       round(avg(TRY_CAST(appver AS DOUBLE)), 6) AS user_avg_appver,
       max(TRY_CAST(appver AS DOUBLE)) AS user_max_appver,
       min(TRY_CAST(appver AS DOUBLE)) AS user_min_appver"""

SQL["user_stats"] = f"""{EL}
SELECT did, {_USER} FROM event_log GROUP BY did
"""

SQL["user_stats_span"] = f"""{EL}
SELECT did, {_USER}, round((max(common_ts) - min(common_ts)) / 1000.0, 6) AS ts_span
FROM event_log GROUP BY did
"""


def _mode_sql(src: str, key: str, col: str, out: str) -> str:
    return f"""(SELECT {key}, {col} AS {out} FROM (
      SELECT {key}, {col}, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {col}) AS rn
      FROM (SELECT {key}, {col}, count(*) AS n FROM {src} WHERE {col} IS NOT NULL
            GROUP BY {key}, {col})) WHERE rn = 1)"""


SQL["device_profile"] = f"""{EL},
b AS (
  SELECT did, count(*) AS total_events, count(DISTINCT mid) AS unique_mids,
         count(DISTINCT eid) AS unique_eids,
         (max(common_ts) - min(common_ts)) / 3600000.0 AS span_h,
         count(DISTINCT channel) AS unique_channels,
         count(DISTINCT device_brand) AS unique_brands,
         count(DISTINCT hour(epoch_ms(common_ts))) AS hour_diversity,
         count(DISTINCT isodow(epoch_ms(common_ts))) AS day_diversity
  FROM event_log GROUP BY did)
SELECT b.did, total_events, unique_mids, unique_eids, round(span_h, 6) AS ts_span_hours,
       unique_channels, unique_brands, hour_diversity, day_diversity,
       round(total_events / greatest(span_h, 1.0), 6) AS avg_events_per_hour,
       coalesce(mm.most_common_mid, 0) AS most_common_mid,
       coalesce(me.most_common_eid, '0') AS most_common_eid
FROM b LEFT JOIN {_mode_sql('event_log', 'did', 'mid', 'most_common_mid')} mm USING (did)
       LEFT JOIN {_mode_sql('event_log', 'did', 'eid', 'most_common_eid')} me USING (did)
"""

SQL["device_mode"] = f"""{EL},
k AS (SELECT DISTINCT did FROM event_log)
SELECT k.did, CAST(coalesce(m.most_common_channel, 0) AS SMALLINT) AS most_common_channel
FROM k LEFT JOIN {_mode_sql('event_log', 'did', 'channel', 'most_common_channel')} m USING (did)
"""

# --- ordering features --------------------------------------------------------------------

SQL["event_rank"] = f"""{EL}
SELECT row_id, did,
       row_number() OVER (PARTITION BY did ORDER BY common_ts, row_id) AS event_rank
FROM event_log
"""

_FIRST = """min(common_ts) OVER (PARTITION BY did) AS common_ts_min,
       first(eid) OVER (PARTITION BY did ORDER BY common_ts, row_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_eid"""

SQL["first_event"] = f"""{EL}
SELECT row_id, {_FIRST} FROM event_log
"""

SQL["since_first"] = f"""{EL}
SELECT row_id,
       round(coalesce((common_ts - min(common_ts) OVER (PARTITION BY did)) / 1000.0, 0), 6)
         AS time_since_first
FROM event_log
"""

SQL["two_key_join"] = f"""{EL},
u AS (SELECT row_id, did, common_ts FROM event_log WHERE split = 'train'
      UNION ALL SELECT row_id, did, common_ts FROM event_log WHERE split = 'test'),
f AS (SELECT row_id,
             row_number() OVER (PARTITION BY did ORDER BY common_ts, row_id) AS event_rank,
             round(coalesce((common_ts - min(common_ts) OVER (PARTITION BY did)) / 1000.0, 0), 6)
               AS time_since_first
      FROM u)
SELECT t.row_id, f.event_rank, f.time_since_first
FROM (SELECT row_id FROM event_log WHERE split = 'train') t LEFT JOIN f USING (row_id)
"""


def _seq_sql(src: str, tok: str) -> str:
    return f"""SELECT row_id, repeat('0 ', 50 - len(l)) || array_to_string(l, ' ') AS seq FROM (
  SELECT row_id, list(CAST({tok} AS VARCHAR)) OVER (PARTITION BY did ORDER BY common_ts, row_id
                            ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS l
  FROM {src})"""


SQL["trailing_sequence"] = f"""{EL}
{_seq_sql('event_log', 'eid')}
"""

SQL["sequence_carried"] = f"""{EL},
q AS ({_seq_sql('event_log', 'eid')}),
w AS (SELECT row_id, common_ts, (SELECT (min(common_ts) + max(common_ts)) // 2 FROM event_log) AS cut,
             row_number() OVER (PARTITION BY did ORDER BY common_ts, row_id) AS event_rank,
             first(eid IGNORE NULLS) OVER (PARTITION BY did ORDER BY common_ts, row_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_token,
             round(coalesce((common_ts - min(common_ts) OVER (PARTITION BY did)) / 1000.0, 0), 6)
               AS time_since_first
      FROM event_log)
SELECT w.row_id, event_rank, first_token, time_since_first, seq
FROM w JOIN q USING (row_id) WHERE common_ts >= cut OR common_ts IS NULL
"""

SQL["encoded_sequence"] = f"""{EL},
v AS (SELECT value, row_number() OVER (ORDER BY value) AS code FROM (
        SELECT DISTINCT eid AS value FROM event_log WHERE split = 'train'
        UNION SELECT '<UNK>')),
e AS (SELECT l.row_id, l.did, l.common_ts,
             coalesce(v.code, (SELECT code FROM v WHERE value = '<UNK>')) AS code
      FROM event_log l LEFT JOIN v ON l.eid = v.value)
{_seq_sql('e', 'code')}
"""

# --- missing values -----------------------------------------------------------------------

SQL["fill_median"] = f"""{EL},
a AS (SELECT row_id, TRY_CAST(appver AS DOUBLE) AS x FROM event_log)
SELECT row_id, round(coalesce(x, (SELECT median(x) FROM a)), 6) AS appver_num FROM a
"""

SQL["fill_mode"] = f"""{EL},
mb AS (SELECT device_brand AS v FROM event_log WHERE device_brand IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
ma AS (SELECT appver AS v FROM event_log WHERE appver IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT row_id, coalesce(device_brand, (SELECT v FROM mb)) AS device_brand,
       coalesce(appver, (SELECT v FROM ma)) AS appver
FROM event_log
"""

SQL["fill_mean"] = f"""{EL},
a AS (SELECT row_id, split, TRY_CAST(appver AS DOUBLE) AS x FROM event_log)
SELECT row_id, round(coalesce(x, (SELECT avg(x) FROM a WHERE split = 'train')), 6) AS appver_num
FROM a
"""

SQL["fill_constant"] = f"""{EL}
SELECT row_id, CAST(coalesce(device_brand, -1) AS SMALLINT) AS device_brand,
       coalesce(appver, 'unknown_appver') AS appver
FROM event_log
"""

# --- encoding and scaling -----------------------------------------------------------------

_VOCAB_COLS = ["eid", "appver", "channel", "did"]
_VOCAB = "vc AS (SELECT \"column\", value, CAST(row_number() OVER (PARTITION BY \"column\" " \
         "ORDER BY value) - 1 AS INTEGER) AS code FROM (" + " UNION ".join(
             f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM event_log "
             f"WHERE split = 'train' AND {c} IS NOT NULL UNION SELECT '{c}', '___UNSEEN___'"
             for c in _VOCAB_COLS) + "))"

SQL["vocab"] = f"""{EL}, {_VOCAB}
SELECT "column", value, code FROM vc
"""

SQL["encode_unseen"] = f"""{EL}, {_VOCAB}
SELECT t.row_id, """ + ", ".join(
    f"""coalesce((SELECT code FROM vc WHERE "column" = '{c}' AND value = CAST(t.{c} AS VARCHAR)),
                (SELECT code FROM vc WHERE "column" = '{c}' AND value = '___UNSEEN___'))
         AS {c}_encoded""" for c in _VOCAB_COLS) + """
FROM event_log t WHERE t.split = 'test'
"""

SQL["code_width"] = f"""{EL}, {_VOCAB}
SELECT "column" AS column_name, count(*) AS n_categories,
       CAST(least(50, greatest(2, count(*) // 2)) AS INTEGER) AS code_width,
       CAST(least(100, greatest(2, count(*) // 4)) AS INTEGER) AS code_width_wide
FROM vc GROUP BY 1
"""

_SCALE_COLS = ["mid", "channel", "os_type", "device_brand"]
SQL["standard_scale"] = f"""{EL},
s AS (SELECT {', '.join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}"
                        for c in _SCALE_COLS)}
      FROM event_log WHERE split = 'train')
SELECT row_id, {', '.join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALE_COLS)}
FROM event_log, s
"""

_KEYS = f"coalesce(CASE WHEN {OBJ} THEN array_to_string(list_sort(json_keys({J})), ' ') END, '')"
_BAG = f"""t AS (SELECT row_id, unnest(regexp_extract_all(lower({_KEYS}), '\\b\\w\\w+\\b')) AS term
       FROM event_log),
bv AS (SELECT term, total, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index
       FROM (SELECT term, count(*) AS total FROM t GROUP BY term
             ORDER BY total DESC, term LIMIT 50))"""

SQL["bag_vocab"] = f"""{ELB}, {_BAG}
SELECT term, total, term_index FROM bv
"""

SQL["bag_of_keys"] = f"""{ELB}, {_BAG}
SELECT t.row_id, bv.term_index, count(*) AS n FROM t JOIN bv USING (term)
GROUP BY t.row_id, bv.term_index
"""

# --- splits -------------------------------------------------------------------------------

_RANK = ("row_number() OVER (PARTITION BY {g} ORDER BY md5('42|' || CAST({i} AS VARCHAR)), {i})")

SQL["stratified_folds"] = f"""{EL}
SELECT row_id, is_new_did,
       CAST(({_RANK.format(g='is_new_did', i='row_id')} - 1) % 5 AS INTEGER) AS fold
FROM event_log
"""

SQL["holdout"] = f"""{EL}
SELECT row_id,
       CAST({_RANK.format(g='is_new_did', i='row_id')}
            <= floor(0.2 * count(*) OVER (PARTITION BY is_new_did)) AS INTEGER) AS is_valid
FROM event_log
"""

SQL["undersample"] = f"""{EL},
tr AS (SELECT * FROM event_log WHERE split = 'train'),
c AS (SELECT is_new_did, count(*) AS n FROM tr GROUP BY 1),
k AS (SELECT is_new_did, CASE WHEN n = (SELECT min(n) FROM c) THEN n
             ELSE least(n, floor((SELECT min(n) FROM c) / 0.5)) END AS keep FROM c),
r AS (SELECT row_id, is_new_did, {_RANK.format(g='is_new_did', i='row_id')} AS rk FROM tr)
SELECT r.row_id, r.is_new_did FROM r JOIN k USING (is_new_did) WHERE rk <= keep
"""

SQL["class_weight"] = f"""{EL}
SELECT CAST(sum(is_new_did) AS BIGINT) AS n_pos, CAST(sum(1 - is_new_did) AS BIGINT) AS n_neg,
       round(sum(1 - is_new_did) / sum(is_new_did), 6) AS pos_weight
FROM event_log
"""

# --- metrics on fixed scores --------------------------------------------------------------

LI = """WITH d AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS score
                FROM lineitem)"""
ORD = """WITH d AS (SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
                       o_totalprice AS score FROM orders)"""
ORDF = ORD + """, df AS (SELECT *, CAST((row_number() OVER (PARTITION BY y
          ORDER BY md5('42|' || CAST(row_id AS VARCHAR)), row_id) - 1) % 5 AS INTEGER) AS fold
          FROM d)"""


def _curve(src: str, groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups}" if groups else ""
    return f"""sc AS (SELECT {g}CAST(score AS DOUBLE) AS threshold, sum(y) AS pos, sum(1 - y) AS neg
        FROM {src} WHERE score IS NOT NULL GROUP BY {g}threshold),
cv AS (SELECT {g}threshold, pos, neg,
        sum(pos) OVER ({part} ORDER BY threshold DESC) AS tp,
        sum(neg) OVER ({part} ORDER BY threshold DESC) AS fp,
        sum(pos) OVER ({part}) AS n_pos
        FROM sc),
pr AS (SELECT {g}threshold, tp, fp,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
        CASE WHEN n_pos > 0 THEN tp / n_pos ELSE 1.0 END AS recall FROM cv),
f1 AS (SELECT *, coalesce(CASE WHEN isnan(2 * recall * precision / (recall + precision + 1e-8))
                          THEN 0.0 ELSE 2 * recall * precision / (recall + precision + 1e-8) END,
                          0.0) AS f1 FROM pr)"""


def _auc(src: str, groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups}" if groups else ""
    return f"""sa AS (SELECT {g}score, sum(y) AS pos, sum(1 - y) AS neg FROM {src}
        WHERE score IS NOT NULL GROUP BY {g}score),
ra AS (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_lt FROM sa),
au AS (SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
        sum(CAST(pos AS DOUBLE) * (neg_lt + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))
        END AS auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
        FROM ra {('GROUP BY ' + groups) if groups else ''})"""


SQL["auc"] = f"""{LI}, {_auc('d')}
SELECT round(auc, 6) AS auc, n_pos, n_neg FROM au
"""

SQL["auc_few_ties"] = f"""{ORD}, {_auc('d')}
SELECT round(auc, 6) AS auc, n_pos, n_neg FROM au
"""

SQL["pr_curve"] = f"""{LI}, {_curve('d')}
SELECT round(threshold, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr
"""

SQL["best_f1"] = f"""{ORD}, {_curve('d')}
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM f1
ORDER BY f1 DESC, threshold LIMIT 1
"""

SQL["best_f1_strict"] = f"""{LI}, {_curve('d')},
s AS (SELECT threshold, 2 * precision * recall / (precision + recall) AS f FROM pr
      WHERE precision + recall > 0),
b AS (SELECT threshold, f FROM s WHERE f > 0 ORDER BY f DESC, threshold LIMIT 1)
SELECT round(coalesce((SELECT threshold FROM b), 0.5), 6) AS threshold,
       round(coalesce((SELECT f FROM b), 0.0), 6) AS f1
"""

SQL["accuracy"] = f"""{LI}
SELECT round(avg(CAST(y = CAST(score >= 0.05 AS INTEGER) AS DOUBLE)), 6) AS accuracy FROM d
"""

SQL["f1_at"] = f"""{LI},
c AS (SELECT CAST(sum(CASE WHEN y = 1 AND score > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN y = 0 AND score > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN y = 1 AND NOT score > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN y = 0 AND NOT score > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM d)
SELECT tp, fp, fn, tn,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1
FROM c
"""

SQL["report"] = f"""{LI},
c AS (SELECT sum(CASE WHEN y = 1 AND score >= 0.05 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y = 0 AND score >= 0.05 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y = 1 AND score < 0.05 THEN 1 ELSE 0 END) AS fn,
             sum(CASE WHEN y = 0 AND score < 0.05 THEN 1 ELSE 0 END) AS tn FROM d),
m AS (SELECT CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
             CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
             tn + fp AS s0, tp + fn AS s1, tp + tn AS ok FROM c),
f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
                CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
                s0 + s1 AS n FROM m)
SELECT '0' AS class_name, round(p0, 6) AS precision, round(r0, 6) AS recall,
       round(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(ok / n, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6),
                 round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6),
                 round((r0 * s0 + r1 * s1) / n, 6), round((f0 * s0 + f1 * s1) / n, 6),
                 CAST(n AS BIGINT) FROM f
"""

SQL["fold_thresholds"] = f"""{ORDF}, {_curve('df', 'fold')},
per AS (SELECT fold, f1, threshold FROM (
          SELECT *, row_number() OVER (PARTITION BY fold ORDER BY f1 DESC, threshold) AS rn
          FROM f1) WHERE rn = 1),
oall AS (SELECT threshold, f1 FROM (
          WITH {_curve('df')} SELECT threshold, f1 FROM f1 ORDER BY f1 DESC, threshold LIMIT 1))
SELECT 'fold_' || CAST(fold + 1 AS VARCHAR) AS fold, round(f1, 6) AS f1_score,
       round(threshold, 6) AS threshold FROM per
UNION ALL SELECT 'OOF', round(f1, 6), round(threshold, 6) FROM oall
UNION ALL SELECT 'Average', round(avg(f1), 6), round(avg(threshold), 6) FROM per
"""

SQL["log_loss"] = f"""{LI}
SELECT round(avg(-(y * ln(least(greatest(score, 1e-15), 1 - 1e-15))
                 + (1 - y) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)))), 6) AS log_loss
FROM d
"""

SQL["two_labelings"] = f"""{ORDF}, {_curve('df', 'fold')},
per AS (SELECT fold, f1, threshold FROM (
          SELECT *, row_number() OVER (PARTITION BY fold ORDER BY f1 DESC, threshold) AS rn
          FROM f1) WHERE rn = 1),
oall AS (SELECT threshold FROM (
          WITH {_curve('df')} SELECT threshold, f1 FROM f1 ORDER BY f1 DESC, threshold LIMIT 1)),
t AS (SELECT (SELECT threshold FROM oall) AS t_oof, (SELECT avg(threshold) FROM per) AS t_avg)
SELECT round(t_oof, 6) AS threshold_oof, round(avg(CAST(score >= t_oof AS INTEGER)), 6) AS rate_oof,
       round(t_avg, 6) AS threshold_avg, round(avg(CAST(score >= t_avg AS INTEGER)), 6) AS rate_avg
FROM df, t GROUP BY t_oof, t_avg
"""

SQL["mean_fold_metric"] = f"""{ORDF}, {_auc('df', 'fold')}
SELECT round(avg(auc), 6) AS mean_auc, count(*) AS n_folds FROM au
"""

SQL["prediction_summary"] = f"""{LI}
SELECT round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score,
       round(avg(CAST(score >= 0.05 AS INTEGER)), 6) AS positive_rate FROM d
"""

# --- reports on importance / registry stand-ins -------------------------------------------

IMP = """WITH imp AS (
  SELECT 'supp_' || CAST(l_suppkey AS VARCHAR) || CASE WHEN l_returnflag = 'R' THEN '_encoded'
         ELSE '' END AS feature, l_discount AS importance, l_linenumber AS fold
  FROM lineitem)"""

SQL["mean_importance"] = f"""{IMP}
SELECT feature, round(avg(importance), 6) AS importance_mean FROM imp GROUP BY feature
"""

SQL["top_features"] = f"""{IMP}
SELECT feature, round(avg(importance), 6) AS importance_mean FROM imp GROUP BY feature
ORDER BY avg(importance) DESC, feature LIMIT 20
"""

SQL["wide_importance"] = f"""{IMP},
per AS (SELECT feature, fold, avg(importance) AS v FROM imp GROUP BY feature, fold)
SELECT feature, """ + ", ".join(
    f"round(max(CASE WHEN fold = {k} THEN v END), 6) AS fold_{k}" for k in range(1, 8)) + """,
       round(avg(v), 6) AS mean
FROM per GROUP BY feature
"""

SQL["importance_cut"] = f"""{IMP},
m AS (SELECT feature, avg(importance) AS mi FROM imp GROUP BY feature),
s AS (SELECT feature, mi / (SELECT sum(mi) FROM m) AS share FROM m)
SELECT CASE WHEN suffix(feature, '_encoded') THEN left(feature, length(feature) - 8)
            ELSE feature END AS column_name,
       CASE WHEN suffix(feature, '_encoded') THEN 'categorical' ELSE 'numeric' END AS kind,
       round(share, 6) AS share
FROM s WHERE share > 0.005
"""

SQL["distinct_values"] = f"""{EL}
SELECT DISTINCT eid FROM event_log
"""

_SHAPE_TYPES = [("row_id", "bigint"), ("did", "string"), ("mid", "int"), ("eid", "string"),
                ("device_brand", "smallint"), ("ntt", "tinyint"), ("operator", "tinyint"),
                ("common_country", "smallint"), ("common_province", "smallint"),
                ("common_city", "smallint"), ("appver", "string"), ("channel", "smallint"),
                ("os_type", "tinyint"), ("common_ts", "bigint"), ("udmap", "string"),
                ("is_new_did", "tinyint"), ("split", "string")]
SQL["shape_report"] = f"""{EL},
t(position, column_name, data_type) AS (VALUES """ + ", ".join(
    f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(_SHAPE_TYPES)) + """)
SELECT CAST(position AS INTEGER) AS position, column_name, data_type,
       (SELECT count(*) FROM event_log) AS n_rows,
       CAST((SELECT count(*) FROM t) AS INTEGER) AS n_columns
FROM t
"""

REG = """WITH reg AS (
  SELECT 'best_model_f1_0.' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') || '_epoch_'
         || CAST(o_custkey AS VARCHAR) || '.pth' AS path, epoch_us(o_orderdate) AS saved_at
  FROM orders),
r AS (SELECT path, saved_at,
             TRY_CAST(nullif(regexp_extract(path, 'f1_([0-9]+\\.[0-9]+)', 1), '') AS DOUBLE) AS f1
      FROM reg)"""

SQL["registry_best"] = f"""{REG}
SELECT path, round(f1, 6) AS f1 FROM r WHERE f1 IS NOT NULL ORDER BY f1 DESC, path DESC LIMIT 1
"""

SQL["registry_newest"] = f"""{REG}
SELECT path, saved_at FROM r ORDER BY saved_at DESC, path DESC LIMIT 1
"""

SQL["trials_left"] = """
SELECT o_orderkey AS trial_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey)
"""

SQL["day_part"] = f"""{EL}
SELECT row_id, CAST(hour(epoch_ms(common_ts)) AS INTEGER) AS hour,
       CAST(hour(epoch_ms(common_ts)) // 6 AS INTEGER) AS time_period
FROM event_log
"""

SQL["weekend"] = f"""{EL}
SELECT row_id, CAST(isodow(epoch_ms(common_ts)) - 1 AS INTEGER) AS day_of_week,
       CAST(isodow(epoch_ms(common_ts)) - 1 >= 5 AS INTEGER) AS is_weekend
FROM event_log
"""

SQL["json_default_zero"] = f"""{ELB}
SELECT row_id, coalesce({jval('botId')}, '0') AS botId, coalesce({jval('pluginId')}, '0') AS pluginId
FROM event_log
"""


def _profile_sql(src: str) -> str:
    """Device profile (A6 + A7) over ``src`` rows, unrounded."""
    return f"""(SELECT b.did, total_events, unique_mids, unique_eids, span_h AS ts_span_hours,
       total_events / greatest(span_h, 1.0) AS avg_events_per_hour, unique_channels,
       unique_brands, hour_diversity, day_diversity,
       coalesce(mm.most_common_mid, 0) AS most_common_mid,
       coalesce(me.most_common_eid, '0') AS most_common_eid
FROM (SELECT did, count(*) AS total_events, count(DISTINCT mid) AS unique_mids,
             count(DISTINCT eid) AS unique_eids,
             (max(common_ts) - min(common_ts)) / 3600000.0 AS span_h,
             count(DISTINCT channel) AS unique_channels,
             count(DISTINCT device_brand) AS unique_brands,
             count(DISTINCT hour(epoch_ms(common_ts))) AS hour_diversity,
             count(DISTINCT isodow(epoch_ms(common_ts))) AS day_diversity
      FROM {src} GROUP BY did) b
LEFT JOIN {_mode_sql(src, 'did', 'mid', 'most_common_mid')} mm USING (did)
LEFT JOIN {_mode_sql(src, 'did', 'eid', 'most_common_eid')} me USING (did))"""


_SEQ_CATS = ["mid", "did", "device_brand", "ntt", "operator", "common_country", "common_province",
             "common_city", "appver", "channel", "os_type", "botId", "pluginId", "hour",
             "day_of_week"]
_ALL_SEQ_NUMS = ["total_events", "unique_mids", "unique_eids", "ts_span_hours",
                 "avg_events_per_hour", "unique_channels", "unique_brands", "hour_diversity",
                 "day_diversity"]
_PREP = """SELECT *, CAST(hour(epoch_ms(common_ts)) AS INTEGER) AS hour,
       CAST(isodow(epoch_ms(common_ts)) - 1 AS INTEGER) AS day_of_week,
       coalesce({bot}, '0') AS botId, coalesce({plugin}, '0') AS pluginId
FROM event_log WHERE split = '{split}'"""

SQL["sequence_dataset"] = f"""{EL},
trp AS ({_PREP.format(bot=jval('botId'), plugin=jval('pluginId'), split='train')}),
tep AS ({_PREP.format(bot=jval('botId'), plugin=jval('pluginId'), split='test')}),
trn AS (SELECT * FROM trp JOIN {_profile_sql('trp')} p USING (did)),
ten AS (SELECT * FROM tep JOIN {_profile_sql('tep')} p USING (did)),
st AS (SELECT {', '.join(f"avg(coalesce({c}, 0)) AS m_{c}, "
                         f"coalesce(nullif(stddev_pop(coalesce({c}, 0)), 0), 1) AS s_{c}"
                         for c in _ALL_SEQ_NUMS)} FROM trn),
vc AS (SELECT col, value, CAST(row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS INTEGER)
              AS code FROM ({' UNION '.join(
                  f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM trp "
                  f"WHERE {c} IS NOT NULL UNION SELECT '{c}', '<UNK>'" for c in _SEQ_CATS)})),
ev AS (SELECT value, row_number() OVER (ORDER BY value) AS code FROM (
         SELECT DISTINCT eid AS value FROM trp UNION SELECT '<UNK>')),
coded AS (
  SELECT t.*, coalesce((SELECT code FROM ev WHERE value = t.eid),
                       (SELECT code FROM ev WHERE value = '<UNK>')) AS eid_code,
         {', '.join(f"coalesce((SELECT code FROM vc WHERE col = '{c}' AND value = CAST(t.{c} AS VARCHAR)), "
                    f"(SELECT code FROM vc WHERE col = '{c}' AND value = '<UNK>')) AS {c}_encoded"
                    for c in _SEQ_CATS)}
  FROM ten t),
sq AS (SELECT *, list(CAST(eid_code AS VARCHAR)) OVER (PARTITION BY did ORDER BY common_ts, row_id
                  ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS l FROM coded)
SELECT row_id, repeat('0 ', 50 - len(l)) || array_to_string(l, ' ') AS seq,
       {', '.join(f"{c}_encoded" for c in _SEQ_CATS)},
       {', '.join(f"round((coalesce({c}, 0) - m_{c}) / s_{c}, 6) AS {c}" for c in _ALL_SEQ_NUMS)}
FROM sq, st
"""

SQL["two_key_fanout"] = f"""{EL},
d AS (SELECT *, common_ts // 86400000 AS day FROM event_log)
SELECT a.row_id, b.mid, b.channel FROM d a JOIN d b ON a.did = b.did AND a.day = b.day
WHERE a.split = 'train'
"""

SQL["two_key_rows"] = f"""{EL}
SELECT row_id, row_number() OVER (PARTITION BY did ORDER BY common_ts, row_id) AS event_rank
FROM event_log
"""

SQL["csv_by_name"] = f"""{EL}
SELECT row_id, did, mid, eid, CASE WHEN row_id % 5 = 0
  THEN 'a "b"' || chr(10) || CAST(row_id AS VARCHAR) ELSE appver END AS appver, common_ts,
  is_new_did, 0 AS __bad_cells
FROM event_log
"""

SQL["number_text"] = f"""{EL}
SELECT row_id, CASE row_id % 12 WHEN 5 THEN 3.0 WHEN 6 THEN -150.0 WHEN 7 THEN 0.5 WHEN 8 THEN 7.0
  WHEN 11 THEN CAST(mid AS DOUBLE) END::DOUBLE AS number FROM event_log
"""

SQL["weighted_rows"] = f"""{EL}
SELECT row_id, round(CASE WHEN is_new_did = 1 THEN (
  SELECT sum(1 - is_new_did) / sum(is_new_did) FROM event_log) ELSE 1.0 END, 6) AS weight
FROM event_log
"""

SQL["log_loss_logits"] = f"""{LI},
z AS (SELECT y, (score - 0.05) * 4000 AS z FROM d)
SELECT round(avg(3.0 * y * (greatest(-z, 0) + ln(1 + exp(-abs(z))))
  + (1 - y) * (greatest(z, 0) + ln(1 + exp(-abs(z))))), 6) AS log_loss FROM z
"""

SQL["sigmoid_scores"] = """
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(l_discount - 0.05) * 200)), 6) AS score
FROM lineitem
"""

_TRAIN = EL + ", tr AS (SELECT * FROM event_log WHERE split = 'train')"

SQL["search_shared"] = f"""{LI},
t AS (SELECT threshold, row_number() OVER (ORDER BY threshold) - 1 AS n FROM (SELECT DISTINCT score AS threshold FROM d)),
c AS (SELECT n, threshold, sum(CASE WHEN y = 1 AND score >= threshold THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y = 0 AND score >= threshold THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y = 1 AND NOT score >= threshold THEN 1 ELSE 0 END) AS fn
      FROM t, d GROUP BY n, threshold)
SELECT CAST(n AS INTEGER) AS trial_id, round(threshold, 6) AS threshold,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1,
       CASE WHEN n < 4 THEN 'first' ELSE 'last' END AS worker,
       CASE WHEN n = 4 THEN 1 ELSE 0 END AS generation
FROM c
"""

SQL["gbt_oof"] = f"""{_TRAIN}
SELECT row_id, CAST(is_new_did AS INTEGER) AS label,
       CAST(({_RANK.format(g='is_new_did', i='row_id')} - 1) % 5 AS INTEGER) AS fold,
       true AS scored
FROM tr
"""

SQL["fold_importance"] = """
SELECT CAST(range AS INTEGER) AS fold, CAST(23 AS BIGINT) AS n_features, true AS sums_to_one
FROM range(1, 6)
"""

SQL["fold_mean_scores"] = f"""{EL}
SELECT row_id, true AS scored FROM event_log WHERE split = 'test'
"""

SQL["forest_select"] = "SELECT true AS some_kept, true AS above_cut, true AS shares"

SQL["net_scores"] = f"""{_TRAIN},
v AS (SELECT row_id, is_new_did, {_RANK.format(g='is_new_did', i='row_id')}
        <= floor(0.2 * count(*) OVER (PARTITION BY is_new_did)) AS is_valid FROM tr)
SELECT row_id, 'valid' AS part, CAST(is_new_did AS INTEGER) AS label, true AS scored
FROM v WHERE is_valid
UNION ALL SELECT row_id, 'test', NULL, true FROM event_log WHERE split = 'test'
"""

SQL["search_best"] = """
SELECT CAST(2 AS BIGINT) AS trials, CAST(2 AS BIGINT) AS scored, CAST(1 AS BIGINT) AS best,
       CAST(0 AS BIGINT) AS fitted_again
"""

SQL["score_saved"] = f"""{EL}
SELECT row_id, did, true AS scored, true AS same_score, true AS same_rule
FROM event_log WHERE split = 'test'
"""

_PLANTED = f"""{EL},
p AS (SELECT row_id, CAST(((channel IN (1, 4, 6, 9, 12)) <> (hour(epoch_ms(common_ts)) < 8))
        <> ((row_id // 13) % 8 = 0) AS INTEGER) AS planted
      FROM event_log WHERE split = 'train'),
f AS (SELECT row_id, planted, CAST(({_RANK.format(g='planted', i='row_id')} - 1) % 5 AS INTEGER)
        AS fold FROM p)"""

SQL["leaf_boost_folds"] = f"""{_PLANTED}
SELECT fold, count(*) AS n_rows, CAST(sum(planted) AS BIGINT) AS n_positive, true AS good_auc,
       'patience' AS ended, true AS cut_back, true AS planted_gain
FROM f GROUP BY fold
"""

SQL["embed_net"] = f"""{_PLANTED},
v AS (SELECT planted, {_RANK.format(g='planted', i='row_id')}
        <= floor(0.2 * count(*) OVER (PARTITION BY planted)) AS held FROM p)
SELECT CASE WHEN held THEN 'valid' ELSE 'train' END AS part, count(*) AS n_rows,
       CAST(sum(planted) AS BIGINT) AS n_positive, count(*) AS scored, true AS good_auc,
       'patience' AS ended
FROM v GROUP BY held
"""

SQL["category_split"] = f"""{EL}
SELECT channel, count(*) AS n_rows, channel IN (1, 4, 6, 9, 12) AS positive_side
FROM event_log GROUP BY channel
"""

SQL["leaf_search"] = """
SELECT CAST(100 AS BIGINT) AS trials, CAST(100 AS BIGINT) AS scored, CAST(1 AS BIGINT) AS best,
       true AS good_auc, true AS scans_bounded
"""

SQL["registry_files"] = """
SELECT 'net_f1_0.' || lpad(CAST(n_nationkey * 371 % 10000 AS VARCHAR), 4, '0') || '_'
       || CAST(n_nationkey AS VARCHAR) AS path,
       round(CAST('0.' || lpad(CAST(n_nationkey * 371 % 10000 AS VARCHAR), 4, '0') AS DOUBLE), 6) AS f1,
       (SELECT count(*) + 1 FROM nation) AS n_states, true AS newest_is_last
FROM nation ORDER BY f1 DESC, path DESC LIMIT 1
"""

SQL["run_names"] = """
SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m%d_%H%M%S') AS run_name FROM orders
"""

SQL["csv_inferred"] = f"""{EL}
SELECT row_id, CAST(did AS BIGINT) AS did, mid, eid, CAST(channel AS INTEGER) AS channel, common_ts,
       udmap
FROM event_log
"""

SQL["report_csv"] = f"""{EL}
SELECT eid, count(*) AS n, round(avg(is_new_did), 6) AS rate, CAST(1 AS BIGINT) AS files
FROM event_log GROUP BY eid
"""

_STATS = """s AS (
  SELECT did, count(mid) AS mid_count, count(DISTINCT mid) AS mid_nunique,
         count(eid) AS eid_count, count(DISTINCT eid) AS eid_nunique,
         count(DISTINCT device_brand) AS device_brand_nunique,
         min(common_ts) AS common_ts_min, max(common_ts) AS common_ts_max,
         round((max(common_ts) - min(common_ts)) / 1000.0, 6) AS ts_span
  FROM event_log GROUP BY did)"""

SQL["device_stats_bits"] = f"""{EL}, {_STATS} SELECT * FROM s"""

SQL["device_stats_merged"] = SQL["device_stats_bits"]

SQL["stats_joined_bucketed"] = f"""{EL}, {_STATS}
SELECT row_id, did, s.* EXCLUDE (did) FROM event_log LEFT JOIN s USING (did)
"""
