"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each runs over whole tables read from ``sf_dir``. The SQL twins used as
correctness oracles live in ``eventcraft.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.functions import jsonmap
from eventcraft.functions.calendar import add_calendar
from eventcraft.plans import features
from eventcraft.sources.event_log import event_log

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --- flagship: the boosted-tree feature table ---------------------------------------------

@query("stats_joined")
def q_stats_joined(spark, sf):
    """J1 + A1 + F1-F7 + F9: every event with calendar columns, JSON ids and device stats."""
    df = features.tree_features(event_log(spark, sf, udmap="bad_rows"))
    return df.select(
        "row_id", "did", "hour", "day_of_week", "day_of_month", "month", "time_period",
        "is_weekend", "botId", "pluginId", "udmap_is_valid", "mid_count", "mid_nunique",
        "eid_count", "eid_nunique", "device_brand_nunique", "common_ts_min", "common_ts_max",
        F.round("ts_span", 6).alias("ts_span"))


# --- JSON ---------------------------------------------------------------------------------

@query("json_lenient")
def q_json_lenient(spark, sf):
    """botId / pluginId text and an object-valid flag over every event's udmap."""
    df = jsonmap.extract_keys(event_log(spark, sf, udmap="bad_rows"), "udmap")
    return df.select("row_id", "botId", "pluginId", "udmap_is_valid")


@query("calendar_features")
def q_calendar(spark, sf):
    """Hour, weekday (Mon=0), day, month, year, day part, weekend flag."""
    df = add_calendar(event_log(spark, sf))
    return df.select("row_id", "hour", "day_of_week", "day_of_month", "month", "year",
                     "time_period", "is_weekend")


@query("day_part")
def q_day_part(spark, sf):
    """hour bucket [0,6) [6,12) [12,18) [18,24) -> 0..3."""
    df = add_calendar(event_log(spark, sf))
    return df.select("row_id", "hour", "time_period")


@query("weekend")
def q_weekend(spark, sf):
    """F3 + F7: weekday (Mon=0) and the weekend flag."""
    df = add_calendar(event_log(spark, sf))
    return df.select("row_id", "day_of_week", "is_weekend")


@query("json_default_zero")
def q_json_default_zero(spark, sf):
    """key values as text, '0' when missing or unparsable (the sequence-model form)."""
    df = jsonmap.extract_keys_default(event_log(spark, sf, udmap="bad_rows"), "udmap",
                                      {"botId": "0", "pluginId": "0"})
    return df.select("row_id", "botId", "pluginId")


DEVICE_STATS_COLUMNS = ["mid_count", "mid_nunique", "eid_count", "eid_nunique",
                        "device_brand_nunique", "common_ts_min", "common_ts_max"]


# --- shared inputs ------------------------------------------------------------------------

def _el(spark, sf, udmap="props"):
    return event_log(spark, sf, udmap=udmap)


def _split(spark, sf):
    el = _el(spark, sf)
    return el.where(F.col("split") == "train"), el.where(F.col("split") == "test")


def _lineitem_scores(spark, sf):
    """Metric fixture with many tied scores: label l_returnflag = 'R', score l_discount."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                     F.col("l_discount").alias("score"))


def _orders_scores(spark, sf):
    """Metric fixture with nearly unique scores: label o_orderstatus = 'F', score o_totalprice."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("row_id"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                    F.col("o_totalprice").alias("score"))


def _r6(c, name):
    return F.round(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), 6).alias(name)


# --- scans, sinks, slicing ----------------------------------------------------------------

@query("typed_scan")
def q_typed_scan(spark, sf):
    """S5 then S1: write the event log (JSON cells with quotes and commas) as header CSV
    to the shared scratch folder and read it back with the fixed schema."""
    from eventcraft.sources.csv_io import read_events_csv, scratch_path, write_csv
    from eventcraft.sources.schema import event_schema
    el = _el(spark, sf, "bad_rows")
    path = scratch_path(spark, "typed-scan")
    write_csv(el.select("row_id", *event_schema().fieldNames()), path)
    back = read_events_csv(spark, path, with_row_id=True)
    return back.select("row_id", "did", "mid", "eid", "device_brand", "appver", "channel",
                       "common_ts", "udmap", "is_new_did")


@query("csv_by_name")
def q_csv_by_name(spark, sf):
    """S1 + S2: files whose columns stand in another order, with one column too many and
    line ends inside cells, read back by column name."""
    from eventcraft.sources.csv_io import read_events_csv, scratch_path, write_csv
    from eventcraft.sources.schema import event_schema
    el = _el(spark, sf).withColumn("appver", F.when(
        F.col("row_id") % 5 == 0, F.concat_ws("\n", F.lit('a "b"'), F.col("row_id").cast("string")))
        .otherwise(F.col("appver"))).withColumn("extra", F.lit("x,y"))
    path = scratch_path(spark, "by-name")
    write_csv(el.select("extra", *reversed(event_schema().fieldNames()), "row_id"), path)
    back = read_events_csv(spark, path, with_row_id=True, bad_cells="count")
    return back.select("row_id", "did", "mid", "eid", "appver", "common_ts", "is_new_did",
                       "__bad_cells")


@query("number_text")
def q_number_text(spark, sf):
    """Numbers from text of many forms; type suffixes, NaN and words give null."""
    from eventcraft.functions.mathfn import to_number
    el = _el(spark, sf)
    forms = [F.lit(x) for x in NUMBER_FORMS]
    text = F.element_at(F.array(*forms, F.concat(F.lit(" "), F.col("mid").cast("string"))),
                        (F.col("row_id") % (len(forms) + 1) + 1).cast("int"))
    return el.select("row_id", to_number(text).alias("number"))


#: texts that the number query reads in turn
NUMBER_FORMS = ("1d", "2f", "NaN", "Infinity", "x", " 3 ", "-1.5e2", ".5", "7.", "1e", "")


@query("null_counts")
def q_null_counts(spark, sf):
    """M1: null count of every event-log column (one aggregate pass)."""
    from eventcraft.operators.missing import null_counts
    return null_counts(_el(spark, sf, "bad_rows"))


@query("label_counts")
def q_label_counts(spark, sf):
    """Label value counts, most frequent first."""
    return (_el(spark, sf).groupBy("is_new_did").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc()))


@query("label_rate")
def q_label_rate(spark, sf):
    """Share of positive labels."""
    return _el(spark, sf).agg(_r6(F.avg("is_new_did"), "label_rate"))


@query("first_rows")
def q_first_rows(spark, sf):
    """S3: the first 2,000 rows in input order (the small-data mode; the limit is the feature)."""
    return (_el(spark, sf).orderBy("row_id").limit(2000)
            .select("row_id", "did", "eid", "common_ts"))


@query("row_range_split")
def q_row_range_split(spark, sf):
    """Ten contiguous row ranges of ceil(n/10) rows, named train_01 ... train_10."""
    from eventcraft.sources.slicing import assign_row_ranges
    return assign_row_ranges(_el(spark, sf), 10, "train").select("row_id", "part_name")


# --- JSON ---------------------------------------------------------------------------------

@query("json_keys_text")
def q_json_keys_text(spark, sf):
    """the object's keys sorted and joined by spaces ('' when none)."""
    df = _el(spark, sf, "bad_rows")
    return df.select("row_id", jsonmap.sorted_keys_text(F.col("udmap")).alias("udmap_keys_str"))


@query("json_flatten")
def q_json_flatten(spark, sf):
    """chosen keys of the JSON object become columns."""
    return jsonmap.flatten(_el(spark, sf, "bad_rows"), "udmap", prefix="udmap_").select(
        "row_id", "udmap_botId", "udmap_pluginId")


@query("json_default")
def q_json_default(spark, sf):
    """key values as text with unknown_* defaults for missing or unparsable cells."""
    df = jsonmap.extract_keys_default(_el(spark, sf, "bad_rows"), "udmap")
    return df.select("row_id", "botId", "pluginId")


# --- device aggregates --------------------------------------------------------------------

@query("device_stats")
def q_device_stats(spark, sf):
    """A1: per device count/distinct of mid and eid, distinct brands, min/max ts, span."""
    from eventcraft.operators.device import device_stats
    d = device_stats(_el(spark, sf))
    return d.withColumn("ts_span", F.round("ts_span", 6))


@query("device_stats_union")
def q_device_stats_union(spark, sf):
    """A2 + U1: device stats over train (label dropped) union all test."""
    from eventcraft.operators.device import device_stats_union
    tr, te = _split(spark, sf)
    return device_stats_union(tr, te).withColumn("ts_span", F.round("ts_span", 6))


@query("device_first_last")
def q_device_first_last(spark, sf):
    """A3: time-ordered first/last timestamp and first eid per device."""
    from eventcraft.operators.device import device_first_last
    return device_first_last(_el(spark, sf)).withColumn("ts_span", F.round("ts_span", 6))


@query("user_stats")
def q_user_stats(spark, sf):
    """A4 + P6: size, distinct mid/eid/brand, avg/max/min of appver read as a number."""
    from eventcraft.operators.device import user_stats
    d = user_stats(_el(spark, sf))
    return d.withColumn("user_avg_appver", F.round("user_avg_appver", 6))


@query("user_stats_span")
def q_user_stats_span(spark, sf):
    """A5: user stats plus active span in seconds."""
    from eventcraft.operators.device import user_stats
    d = user_stats(_el(spark, sf), with_span=True)
    return d.withColumns({"user_avg_appver": F.round("user_avg_appver", 6),
                          "ts_span": F.round("ts_span", 6)})


@query("device_profile")
def q_device_profile(spark, sf):
    """A6 + A7: device profile with span hours, events per hour and modal mid/eid."""
    from eventcraft.operators.device import device_profile
    d = device_profile(_el(spark, sf))
    return d.withColumns({"ts_span_hours": F.round("ts_span_hours", 6),
                          "avg_events_per_hour": F.round("avg_events_per_hour", 6)})


@query("device_mode")
def q_device_mode(spark, sf):
    """Most frequent channel per device, smallest on ties, 0 when none."""
    from eventcraft.operators.device import group_mode
    return group_mode(_el(spark, sf), "did", "channel", default=0)


# --- ordering features --------------------------------------------------------------------

@query("event_rank")
def q_event_rank(spark, sf):
    """1-based event position in its device by (ts, row_id)."""
    from eventcraft.operators.sequence import event_rank
    return event_rank(_el(spark, sf)).select("row_id", "did", "event_rank")


@query("first_event")
def q_first_event(spark, sf):
    """First timestamp and first eid of the device on every row."""
    from eventcraft.operators.sequence import add_first_and_elapsed
    return add_first_and_elapsed(_el(spark, sf)).select("row_id", "common_ts_min", "first_eid")


@query("since_first")
def q_since_first(spark, sf):
    """Seconds since the device's first event."""
    from eventcraft.operators.sequence import add_first_and_elapsed
    d = add_first_and_elapsed(_el(spark, sf))
    return d.select("row_id", F.round("time_since_first", 6).alias("time_since_first"))


@query("two_key_join")
def q_two_key_join(spark, sf):
    """U1 + W1-W3: rank and elapsed features computed on train union test, kept for the
    train rows (an origin flag tells them apart, no join back)."""
    from eventcraft.plans.features import sequential_features
    el = _el(spark, sf)
    return sequential_features(el).where(F.col("split") == "train").select(
        "row_id", "event_rank", F.round("time_since_first", 6).alias("time_since_first"))


DAY_MS = 86_400_000


@query("two_key_fanout")
def q_two_key_fanout(spark, sf):
    """Features joined on (did, ts) with the time cut to days, so that pairs repeat
    and every event meets all features of its device's day."""
    from eventcraft.operators.device import join_on_time
    el = _el(spark, sf).withColumn("common_ts", (F.floor(F.col("common_ts") / DAY_MS) * DAY_MS)
                                   .cast("bigint"))
    ev = el.where(F.col("split") == "train").select("row_id", "did", "common_ts")
    feats = el.select("row_id", "did", "common_ts", "mid", "channel")
    return join_on_time(ev, feats, fanout=True).select("row_id", "mid", "channel")


@query("two_key_rows")
def q_two_key_rows(spark, sf):
    """J2, one feature row per event: train and test number their rows alike, so the file
    (origin) is part of the row's key."""
    from eventcraft.operators.device import join_on_time
    from eventcraft.operators.sequence import event_rank
    el = _el(spark, sf).withColumn("file_row", F.floor(F.col("row_id") / 5).cast("bigint"))
    feats = event_rank(el).select("did", "common_ts", "split", "file_row", "row_id", "event_rank")
    out = join_on_time(el.select("row_id", "did", "common_ts", "split", "file_row"), feats.drop(
        "row_id"), row_keys=("split", "file_row"))
    return out.select("row_id", "event_rank")


@query("trailing_sequence")
def q_trailing_sequence(spark, sf):
    """W4 + F18: last 50 eids of the device up to this event, left-padded with '0'."""
    from eventcraft.operators.sequence import event_rank, sequence_text, trailing_sequence
    r = event_rank(_el(spark, sf))
    s = trailing_sequence(r, "eid", pad="0")
    return s.select("row_id", sequence_text("seq").alias("seq"))


@query("encoded_sequence")
def q_encoded_sequence(spark, sf):
    """W5 + E2: eid encoded (vocabulary fitted on train, <UNK> for unseen, codes from 1,
    0 reserved for padding), then the trailing sequence of codes."""
    from eventcraft.operators.encode import UNK, encode, fit_vocab
    from eventcraft.operators.sequence import event_rank, sequence_text, trailing_sequence
    el = _el(spark, sf)
    vocab = fit_vocab(el.where(F.col("split") == "train"), ["eid"], marker=UNK, first_code=1)
    enc = encode(el, vocab, ["eid"], marker=UNK)
    s = trailing_sequence(event_rank(enc), "eid_encoded", pad=0)
    return s.select("row_id", sequence_text("seq").alias("seq"))


@query("sequence_carried")
def q_sequence_carried(spark, sf):
    """W1-W4 on the later half of the events, given the histories of the earlier half."""
    from eventcraft.operators.carry import continue_events, history_state
    from eventcraft.operators.sequence import sequence_text
    el = _el(spark, sf)
    ends = el.agg(F.min("common_ts").alias("a"), F.max("common_ts").alias("b")).first()
    cut = F.lit((ends["a"] + ends["b"]) // 2)
    old = history_state(el.where(F.col("common_ts") < cut)).checkpoint(eager=True)
    new = el.where(F.coalesce(F.col("common_ts") >= cut, F.lit(True)))
    rows, _ = continue_events(old, new)
    return rows.select("row_id", "event_rank", "first_token", F.round("time_since_first", 6).alias(
        "time_since_first"), sequence_text("seq").alias("seq"))


# --- missing values -----------------------------------------------------------------------

def _appver_num(df):
    from eventcraft.functions.mathfn import to_number
    return df.withColumn("appver_num", to_number(F.col("appver")))


@query("fill_median")
def q_fill_median(spark, sf):
    """M2: exact median fill of appver read as a number (nulls from bad text)."""
    from eventcraft.operators.missing import fill_median
    d = fill_median(_appver_num(_el(spark, sf)), ["appver_num"])
    return d.select("row_id", F.round("appver_num", 6).alias("appver_num"))


@query("fill_mode")
def q_fill_mode(spark, sf):
    """M3: mode fill (smallest on ties) of id columns with nulls."""
    from eventcraft.operators.missing import fill_mode
    d = fill_mode(_el(spark, sf), ["device_brand", "appver"])
    return d.select("row_id", "device_brand", "appver")


@query("fill_mean")
def q_fill_mean(spark, sf):
    """M5: mean fitted on the train split, applied to every row."""
    from eventcraft.operators.missing import fill_mean, fit_means
    el = _appver_num(_el(spark, sf))
    means = fit_means(el.where(F.col("split") == "train"), ["appver_num"])
    d = fill_mean(el, ["appver_num"], means)
    return d.select("row_id", F.round("appver_num", 6).alias("appver_num"))


@query("fill_constant")
def q_fill_constant(spark, sf):
    """M4: constant fill: -1 for a numeric id, a text marker for a text id."""
    from eventcraft.operators.missing import fill_constant
    d = fill_constant(_el(spark, sf), {"device_brand": -1, "appver": "unknown_appver"})
    return d.select("row_id", "device_brand", "appver")


# --- encoding and scaling -----------------------------------------------------------------

VOCAB_COLS = ["eid", "appver", "channel", "did"]


@query("vocab")
def q_vocab(spark, sf):
    """Sorted distinct values + ___UNSEEN___ per column, code = position (train split)."""
    from eventcraft.operators.encode import fit_vocab
    tr, _ = _split(spark, sf)
    return fit_vocab(tr, VOCAB_COLS)


@query("encode_unseen")
def q_encode_unseen(spark, sf):
    """E1 transform + P9/J4: test rows encoded with the train vocabulary; unseen -> marker."""
    from eventcraft.operators.encode import encode, fit_vocab
    tr, te = _split(spark, sf)
    v = fit_vocab(tr, VOCAB_COLS)
    return encode(te, v, VOCAB_COLS).select("row_id", *[f"{c}_encoded" for c in VOCAB_COLS])


@query("code_width")
def q_code_width(spark, sf):
    """Vocabulary size and embedding width per column."""
    from eventcraft.operators.encode import fit_vocab, vocab_sizes
    tr, _ = _split(spark, sf)
    return vocab_sizes(fit_vocab(tr, VOCAB_COLS)).withColumnRenamed("column", "column_name")


@query("standard_scale")
def q_standard_scale(spark, sf):
    """(x - mean) / population std with train statistics, zero std -> 1."""
    from eventcraft.operators.encode import fit_scaler, scale
    tr, te = _split(spark, sf)
    cols = ["mid", "channel", "os_type", "device_brand"]
    st = fit_scaler(tr, cols)
    d = scale(_el(spark, sf), st)
    return d.select("row_id", *[F.round(c, 6).alias(c) for c in cols])


@query("bag_vocab")
def q_bag_vocab(spark, sf):
    """E4 fit: top-50 terms of the sorted-key text, indexed alphabetically."""
    from eventcraft.operators.encode import fit_bag
    d = _el(spark, sf, "bad_rows").select(jsonmap.sorted_keys_text(F.col("udmap")).alias("k"))
    return fit_bag(d, "k")


@query("bag_of_keys")
def q_bag_of_keys(spark, sf):
    """E4 transform: per row, counts of each vocabulary term (non-zero, long form)."""
    from eventcraft.operators.encode import bag_long, fit_bag
    d = _el(spark, sf, "bad_rows").select(
        "row_id", jsonmap.sorted_keys_text(F.col("udmap")).alias("k"))
    return bag_long(d, "k", fit_bag(d, "k"))


# --- splits -------------------------------------------------------------------------------

@query("stratified_folds")
def q_stratified_folds(spark, sf):
    """5 stratified folds by per-label rank of md5('42|row_id')."""
    from eventcraft.operators.split import stratified_folds
    return stratified_folds(_el(spark, sf), "is_new_did", 5, 42).select(
        "row_id", "is_new_did", "fold")


@query("holdout")
def q_holdout(spark, sf):
    """R2: stratified 80/20 holdout, seed 42."""
    from eventcraft.operators.split import holdout
    return holdout(_el(spark, sf), "is_new_did", 0.2, 42).select("row_id", "is_valid")


@query("undersample")
def q_undersample(spark, sf):
    """Majority undersampled to 2 rows per minority row, on the train split."""
    from eventcraft.operators.split import undersample
    tr, _ = _split(spark, sf)
    return undersample(tr, "is_new_did", 0.5, 42).select("row_id", "is_new_did")


@query("class_weight")
def q_class_weight(spark, sf):
    """A11 + R4: class counts and pos_weight = neg / pos."""
    from eventcraft.operators.split import class_counts
    return class_counts(_el(spark, sf), "is_new_did").withColumn(
        "pos_weight", F.round("pos_weight", 6))


@query("weighted_rows")
def q_weighted_rows(spark, sf):
    """Every row with its class weight (pos_weight on positives, 1 on negatives)."""
    from eventcraft.operators.split import class_weight
    return class_weight(_el(spark, sf), "is_new_did").select(
        "row_id", F.round("weight", 6).alias("weight"))


# --- metrics on fixed scores --------------------------------------------------------------

@query("auc")
def q_auc(spark, sf):
    """V1: exact AUC with many ties (lineitem: returnflag R vs discount)."""
    from eventcraft.operators.evaluate import auc
    return auc(_lineitem_scores(spark, sf), "y", "score").withColumn("auc", F.round("auc", 6))


@query("auc_few_ties")
def q_auc_few_ties(spark, sf):
    """V1: exact AUC with nearly unique scores (orders: status F vs total price)."""
    from eventcraft.operators.evaluate import auc
    return auc(_orders_scores(spark, sf), "y", "score").withColumn("auc", F.round("auc", 6))


@query("pr_curve")
def q_pr_curve(spark, sf):
    """V2: precision/recall per distinct score (score >= t)."""
    from eventcraft.operators.evaluate import pr_curve
    c = pr_curve(_lineitem_scores(spark, sf), "y", "score")
    return c.select(F.round("threshold", 6).alias("threshold"), "tp", "fp",
                    F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("best_f1")
def q_best_f1(spark, sf):
    """V3: best guarded-F1 threshold, first maximum (nearly unique scores)."""
    from eventcraft.operators.evaluate import best_f1
    b = best_f1(_orders_scores(spark, sf), "y", "score")
    return b.select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query("best_f1_strict")
def q_best_f1_strict(spark, sf):
    """V4: best unguarded F1, p + r > 0 only, strict improvement (many ties)."""
    from eventcraft.operators.evaluate import best_f1_strict
    b = best_f1_strict(_lineitem_scores(spark, sf), "y", "score")
    return b.select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query("accuracy")
def q_accuracy(spark, sf):
    """V5 + P7: accuracy of score >= 0.05."""
    from eventcraft.functions.mathfn import label_at
    from eventcraft.operators.evaluate import accuracy
    d = _lineitem_scores(spark, sf).withColumn("pred", label_at(F.col("score"), 0.05))
    return accuracy(d, "y", "pred").withColumn("accuracy", F.round("accuracy", 6))


@query("f1_at")
def q_f1_at(spark, sf):
    """V6 + P8: confusion counts and F1 of score > 0.05."""
    from eventcraft.operators.evaluate import f1_at
    return f1_at(_lineitem_scores(spark, sf), "y", "score", 0.05, inclusive=False).withColumn(
        "f1", F.round("f1", 6))


@query("report")
def q_report(spark, sf):
    """V7: classification report of score >= 0.05."""
    from eventcraft.functions.mathfn import label_at
    from eventcraft.operators.evaluate import classification_report
    d = _lineitem_scores(spark, sf).withColumn("pred", label_at(F.col("score"), 0.05))
    r = classification_report(d, "y", "pred")
    return r.select("class_name", *[F.round(c, 6).alias(c) for c in ("precision", "recall",
                                                                     "f1_score")], "support")


@query("fold_thresholds")
def q_fold_thresholds(spark, sf):
    """V8 + R1: best-F1 threshold per stratified fold, plus OOF and Average rows."""
    from eventcraft.operators.evaluate import fold_thresholds
    from eventcraft.operators.split import stratified_folds
    d = stratified_folds(_orders_scores(spark, sf), "y", 5, 42)
    t = fold_thresholds(d, "y", "score")
    return t.select("fold", F.round("f1_score", 6).alias("f1_score"),
                    F.round("threshold", 6).alias("threshold"))


@query("log_loss")
def q_log_loss(spark, sf):
    """V9: mean cross-entropy of discount read as a probability (clamped)."""
    from eventcraft.operators.evaluate import log_loss
    return log_loss(_lineitem_scores(spark, sf), "y", prob="score").withColumn(
        "log_loss", F.round("log_loss", 6))


@query("log_loss_logits")
def q_log_loss_logits(spark, sf):
    """V9: mean cross-entropy of large logits with a positive weight."""
    from eventcraft.operators.evaluate import log_loss
    d = _lineitem_scores(spark, sf).withColumn("z", (F.col("score") - 0.05) * 4000)
    return log_loss(d, "y", logit="z", pos_weight=3.0).withColumn(
        "log_loss", F.round("log_loss", 6))


@query("sigmoid_scores")
def q_sigmoid_scores(spark, sf):
    """logistic scores of logits."""
    from eventcraft.functions.mathfn import sigmoid
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", F.round(sigmoid(
        (F.col("l_discount") - 0.05) * 200), 6).alias("score"))


@query("two_labelings")
def q_two_labelings(spark, sf):
    """Positive rate under the OOF threshold and under the mean fold threshold."""
    from eventcraft.operators.evaluate import two_labelings
    from eventcraft.operators.split import stratified_folds
    d = stratified_folds(_orders_scores(spark, sf), "y", 5, 42)
    t = two_labelings(d, "y", "score")
    return t.select(*[F.round(c, 6).alias(c) for c in t.columns])


@query("mean_fold_metric")
def q_mean_fold_metric(spark, sf):
    """A14 + V1: AUC per stratified fold and their mean."""
    from eventcraft.operators.evaluate import auc
    from eventcraft.operators.split import stratified_folds
    d = stratified_folds(_orders_scores(spark, sf), "y", 5, 42)
    per = auc(d, "y", "score", ["fold"])
    return per.agg(F.round(F.avg("auc"), 6).alias("mean_auc"),
                   F.count(F.lit(1)).alias("n_folds"))


@query("prediction_summary")
def q_prediction_summary(spark, sf):
    """A10: mean and population std of scores, share labelled positive at 0.05."""
    from eventcraft.functions.mathfn import label_at
    d = _lineitem_scores(spark, sf)
    return d.agg(F.round(F.avg("score"), 6).alias("mean_score"),
                 F.round(F.stddev_pop("score"), 6).alias("std_score"),
                 F.round(F.avg(label_at(F.col("score"), 0.05)), 6).alias("positive_rate"))


# --- reports on importance / registry stand-ins -------------------------------------------

def _importance_standin(spark, sf):
    """Rows shaped like a per-fold importance table, read from lineitem."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    feat = F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string"),
                    F.when(F.col("l_returnflag") == "R", F.lit("_encoded")).otherwise(F.lit("")))
    return li.select(feat.alias("feature"), F.col("l_discount").alias("importance"),
                     F.col("l_linenumber").alias("fold"))


@query("mean_importance")
def q_mean_importance(spark, sf):
    """Mean importance per feature."""
    from eventcraft.operators.reports import mean_importance
    m = mean_importance(_importance_standin(spark, sf))
    return m.withColumn("importance_mean", F.round("importance_mean", 6))


@query("top_features")
def q_top_features(spark, sf):
    """K2: top 20 features by mean importance (the limit is the report)."""
    from eventcraft.operators.reports import top_features
    t = top_features(_importance_standin(spark, sf), 20)
    return t.withColumn("importance_mean", F.round("importance_mean", 6))


@query("wide_importance")
def q_wide_importance(spark, sf):
    """One column per fold plus the mean across folds."""
    from eventcraft.operators.reports import wide_importance
    w = wide_importance(_importance_standin(spark, sf))
    return w.select("feature", *[F.round(c, 6).alias(c) for c in w.columns if c != "feature"])


@query("importance_cut")
def q_importance_cut(spark, sf):
    """K3 + F20: features whose importance share exceeds 0.005, by kind."""
    from eventcraft.operators.reports import importance_cut
    c = importance_cut(_importance_standin(spark, sf), 0.005)
    return c.withColumn("share", F.round("share", 6))


@query("distinct_values")
def q_distinct_values(spark, sf):
    """Distinct event ids."""
    from eventcraft.operators.reports import distinct_values
    return distinct_values(_el(spark, sf), "eid")


@query("shape_report")
def q_shape_report(spark, sf):
    """Row count, column count and per-column type of the event log."""
    from eventcraft.operators.reports import shape_report
    return shape_report(_el(spark, sf))


def _registry_standin(spark, sf):
    """Rows shaped like a model registry (file name with its F1, save time), from orders."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    path = F.concat(F.lit("best_model_f1_0."),
                    F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0"),
                    F.lit("_epoch_"), F.col("o_custkey").cast("string"), F.lit(".pth"))
    return o.select(path.alias("path"),
                    F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                           "o_orderdate)").alias("saved_at"))


@query("registry_best")
def q_registry_best(spark, sf):
    """S9 + F19: the saved model whose name carries the best F1."""
    from eventcraft.plans.registry import registry_best
    return registry_best(_registry_standin(spark, sf)).withColumn("f1", F.round("f1", 6))


@query("registry_newest")
def q_registry_newest(spark, sf):
    """The most recently saved model."""
    from eventcraft.plans.registry import registry_newest
    return registry_newest(_registry_standin(spark, sf))


@query("registry_files")
def q_registry_files(spark, sf):
    """S9 + S10 over real files: a state for every nation is saved under a name with its F1;
    the best one by a listing of the folder, how many there are, and whether the newest is the
    one that was saved last."""
    from eventcraft.plans.registry import registry_best, registry_newest, saved_states
    from eventcraft.sources.csv_io import scratch_path
    folder = scratch_path(spark, "states")
    name = F.concat(F.lit("net_f1_0."), F.lpad((F.col("n_nationkey") * 371 % 10000).cast(
        "string"), 4, "0"), F.lit("_"), F.col("n_nationkey").cast("string"))
    states = spark.read.parquet(f"{sf}/nation.parquet").select(
        name.alias("state"), F.to_json(F.struct("n_nationkey", "n_name")).alias("config"))
    states.write.partitionBy("state").text(folder)
    late = states.agg(F.max("config").alias("config")).withColumn("state", F.lit("net_last"))
    import time
    time.sleep(1.1)  # file times may have whole seconds only
    late.write.mode("append").partitionBy("state").text(folder)
    listed = saved_states(spark, folder).withColumn("path", F.regexp_replace("path", "^state=", ""))
    newest = registry_newest(listed).select((F.col("path") == "net_last").alias("newest_is_last"))
    count = listed.agg(F.count(F.lit(1)).alias("n_states"))
    # one row each
    return registry_best(listed).withColumn("f1", F.round("f1", 6)).join(F.broadcast(count)).join(
        F.broadcast(newest))


@query("run_names")
def q_run_names(spark, sf):
    """The run name of every order's time."""
    from eventcraft.sources.csv_io import run_id
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", run_id(F.col("o_orderdate").cast("timestamp")).alias("run_name"))


@query("csv_inferred")
def q_csv_inferred(spark, sf):
    """S2 as an option: events written as CSV and read with inferred types."""
    from eventcraft.sources.csv_io import read_csv_inferred, scratch_path, write_csv
    path = scratch_path(spark, "inferred")
    write_csv(_el(spark, sf).select("row_id", "did", "mid", "eid", "channel", "common_ts", "udmap"), path)
    return read_csv_inferred(spark, path).select(
        F.col("row_id").cast("bigint"), F.col("did").cast("bigint"), F.col("mid").cast("int"), "eid",
        F.col("channel").cast("int"), F.col("common_ts").cast("bigint"), "udmap")


@query("report_csv")
def q_report_csv(spark, sf):
    """A small report as one CSV file with a header, read back."""
    from eventcraft.sources.csv_io import read_csv_inferred, scratch_path, write_csv
    path = scratch_path(spark, "report")
    write_csv(_el(spark, sf).groupBy("eid").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("is_new_did"), 6).alias("rate")), path,
        single_file=True)
    back = read_csv_inferred(spark, path)
    files = len(set(back.inputFiles()))
    return back.select("eid", F.col("n").cast("bigint"), F.col("rate").cast("double"),
                       F.lit(files).cast("bigint").alias("files"))


@query("device_stats_bits")
def q_device_stats_bits(spark, sf):
    """A1 with distinct counts by bitmaps over dictionary codes: no row is expanded."""
    from eventcraft.operators import bitmap
    return bitmap.device_stats(_el(spark, sf)).select("did", *DEVICE_STATS_COLUMNS,
                                                      _r6("ts_span", "ts_span"))


@query("device_stats_merged")
def q_device_stats_merged(spark, sf):
    """A1 carried over to new events: the state of the train half merged with that of the test
    half equals the statistics over all."""
    from eventcraft.operators import bitmap
    el = _el(spark, sf)
    dicts = bitmap.dictionaries(el, bitmap.COUNTED)
    old, new = (bitmap.device_state(x, dicts) for x in _split(spark, sf))
    return bitmap.state_stats(bitmap.merge_states(old, new)).select(
        "did", *DEVICE_STATS_COLUMNS, _r6("ts_span", "ts_span"))


@query("stats_joined_bucketed")
def q_stats_joined_bucketed(spark, sf):
    """J1 + A1 on events stored in buckets by device: neither the statistics nor the join back
    exchanges event rows."""
    from eventcraft.operators import bitmap, device
    from eventcraft.sources.event_log import bucketed_events
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    el = bucketed_events(_el(spark, sf).select(
        "row_id", "did", "mid", "eid", "device_brand", "common_ts"), buckets)
    return device.join_device_stats(el, bitmap.device_stats(el)).select(
        "row_id", "did", *DEVICE_STATS_COLUMNS, _r6("ts_span", "ts_span"))


@query("trials_left")
def q_trials_left(spark, sf):
    """Planned ids (orders) with no finished record (a returned line) - a left anti join."""
    from eventcraft.plans.registry import trials_left
    planned = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("trial_id"))
    done = (spark.read.parquet(f"{sf}/lineitem.parquet").where(F.col("l_returnflag") == "R")
            .select(F.col("l_orderkey").alias("trial_id")))
    return trials_left(planned, done)


@query("search_shared")
def q_search_shared(spark, sf):
    """S11 + S12 with several writers: one trial for each discount, scored by the F1 of score >=
    discount. One worker fits four trials, one claims a trial and dies, one takes that over
    and fits the rest."""
    from eventcraft.operators.evaluate import f1_at
    from eventcraft.plans.claims import Claims, ledger
    from eventcraft.sources.csv_io import scratch_path
    d = _lineitem_scores(spark, sf)
    # a dozen values, whatever the size
    plan = [{"threshold": r["score"]} for r in d.select("score").distinct().orderBy("score").collect()]
    folder = scratch_path(spark, "claims")

    def fit(p):
        return f1_at(d, "y", "score", p["threshold"], inclusive=True).first()["f1"]
    Claims(spark, folder, "first").run(plan, fit, most=4)
    Claims(spark, folder, "dies").claim(range(len(plan)))
    Claims(spark, folder, "last", expiry_s=0).run(plan, fit)
    return ledger(spark, folder).select(
        "trial_id", F.round(
            F.get_json_object("params", "$.threshold").cast("double"), 6).alias("threshold"),
        F.round("score", 6).alias("f1"), "worker", "generation")


# --- model fits: the full fit runs, the twin states what SQL can know of its result --------

def _model_frames(spark, sf):
    d = features.tree_model_frame(_el(spark, sf, "bad_rows"))
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


#: channels of the planted label; no cut of the channel's number separates them
PLANTED = (1, 4, 6, 9, 12)


def planted_label(noise: bool = True):
    """A label that kept columns explain: the channel's set against the early hours; with
    ``noise`` the labels of every eighth run of 13 rows are turned."""
    plain = (F.col("channel").isin(*PLANTED)) != (F.col("hour") < 8)
    turned = F.expr("pmod(row_id div 13, 8) = 0")
    return (plain != turned if noise else plain).cast("int")


def _in_range(c="score"):
    return F.coalesce(F.col(c).between(0, 1), F.lit(False))


def _trees():
    from eventcraft.plans.model import gbt
    return gbt(label="is_new_did", validation_col="__is_val")


@query("gbt_oof")
def q_gbt_oof(spark, sf):
    """L1 + L2 + R1: 5-fold boosted trees, each fold's early stop on its own fold;
    one out-of-fold score per train row."""
    from eventcraft.plans.model import out_of_fold
    tr, _ = _model_frames(spark, sf)
    oof = out_of_fold(tr, features.TREE_MODEL_FEATURES, "is_new_did", 5, 42,
                      make_estimator=_trees)["oof"]
    return oof.select("row_id", F.col("is_new_did").cast("int").alias("label"), "fold",
                      _in_range().alias("scored"))


@query("fold_importance")
def q_fold_importance(spark, sf):
    """L4: importance of every feature in every fold's model, summing to one a fold."""
    from eventcraft.plans.model import out_of_fold
    tr, _ = _model_frames(spark, sf)
    imp = out_of_fold(tr, features.TREE_MODEL_FEATURES, "is_new_did", 5, 42,
                      make_estimator=_trees)["importance"]
    return imp.groupBy("fold").agg(F.count(F.lit(1)).alias("n_features"), (
        F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))


@query("fold_mean_scores")
def q_fold_mean_scores(spark, sf):
    """L3 + R3: each test row's score is the mean over the 5 fold models, whose
    training folds were undersampled to 2 majority rows per minority row."""
    from eventcraft.plans.model import out_of_fold
    tr, te = _model_frames(spark, sf)
    res = out_of_fold(tr, features.TREE_MODEL_FEATURES, "is_new_did", 5, 42, test=te,
                      undersample_ratio=0.5, make_estimator=_trees)
    return res["test"].select("row_id", _in_range().alias("scored"))


@query("forest_select")
def q_forest_select(spark, sf):
    """L5 + K3: 100-tree forest importances on a planted label; how many features there
    were, and whether those kept (with their kind) are the ones above 0.005."""
    from eventcraft.plans.model import forest_select
    tr, _ = _model_frames(spark, sf)
    tr = tr.withColumn("planted", planted_label(noise=False))
    kept = forest_select(tr, features.TREE_MODEL_FEATURES, "planted", 0.005)
    return kept.agg((F.count(F.lit(1)) > 0).alias("some_kept"),
                    F.coalesce(F.min("share") > 0.005, F.lit(False)).alias("above_cut"),
                    (F.sum("share") <= 1 + 1e-9).alias("shares"))


@query("net_scores")
def q_net_scores(spark, sf):
    """L6 + L7 + E1 + E3 + R2: category codes (train vocabulary) one-hot, numbers scaled
    with train statistics, a feed-forward net trained in warm-started rounds with
    patience on an 80/20 stratified holdout; validation and test rows are scored."""
    from eventcraft.operators.encode import encode, fit_scaler, fit_vocab, scale
    from eventcraft.operators.split import holdout
    from eventcraft.plans.model import fit_with_patience, mlp_round, net_inputs, positive_score
    from eventcraft.plans.runs import NET_CATEGORIES, NET_NUMBERS
    from eventcraft.plans.model import LEAKY
    el = _el(spark, sf, "bad_rows")
    cats = [c for c in NET_CATEGORIES if c not in LEAKY]
    # the labelled feature rows feed every fit below: compute them once
    d = holdout(features.net_features(el.where(F.col("split") == "train")), "is_new_did", 0.2, 42)
    d = d.select("row_id", "is_new_did", "is_valid", *cats, *NET_NUMBERS).checkpoint(eager=True)
    te = features.net_features(el.where(F.col("split") == "test")).select(
        "row_id", F.lit(None).cast("tinyint").alias("is_new_did"), *cats, *NET_NUMBERS)
    tr, va = d.where(F.col("is_valid") == 0), d.where(F.col("is_valid") == 1)
    vocab = fit_vocab(tr, cats).checkpoint()
    st = fit_scaler(tr, NET_NUMBERS)
    inputs, frames = None, []
    for part in (tr, va, te):
        x = scale(encode(part, vocab, cats), st, fill_zero=True)
        inputs = inputs or net_inputs([f"{c}_encoded" for c in cats], list(NET_NUMBERS)).fit(x)
        # the assembled frames are read once per training iteration: cut their lineage
        frames.append(inputs.transform(x).select("row_id", "is_new_did", "features").checkpoint())
    tr, va, te = frames
    width = tr.first()["features"].size
    best, _ = fit_with_patience(tr, va, mlp_round(width, "is_new_did", iters_per_round=10),
                                "is_new_did", rounds=50, patience=3)
    both = va.withColumn("part", F.lit("valid")).unionByName(te.withColumn("part", F.lit("test")))
    return positive_score(best.transform(both)).select(
        "row_id", "part", F.col("is_new_did").cast("int").alias("label"),
        _in_range().alias("scored"))


SEARCH_TRIALS = 2


@query("search_best")
def q_search_best(spark, sf):
    """L8 + R3 + S11 + S12: seeded trials, undersampled and scored by 3-fold OOF AUC. The
    ledger has a fixed place for this input in the shared folder, so that a rerun - also
    in a later session - fits only what is missing; the second call here fits none."""
    from eventcraft.plans.model import search
    from eventcraft.plans.registry import read_ledger
    from eventcraft.session import shared_root
    import hashlib
    tr, _ = _model_frames(spark, sf)
    key = hashlib.md5(sf.encode()).hexdigest()
    ledger = f"{shared_root(spark)}/eventcraft-ledger/{key}"

    def go():
        return search(tr, features.TREE_MODEL_FEATURES, "is_new_did", n_trials=SEARCH_TRIALS, k=3,
                      seed=42, ledger_path=ledger, undersample_ratio=0.5)
    go()
    before = read_ledger(spark, ledger, "trial_id int, params string, score double").count()
    out = go()
    return out.agg(F.count(F.lit(1)).alias("trials"), F.count_if(_in_range()).alias("scored"),
                   F.count_if("is_best").alias("best"),
                   (F.count(F.lit(1)) - F.lit(before)).alias("fitted_again"))


@query("score_saved")
def q_score_saved(spark, sf):
    """S7 + S8 + L9 + V3 + P7 + J5: fit on train, pick the best-F1 threshold on a holdout,
    save model and config, load them back and label the test rows with the rule the
    threshold was found with (score >= threshold); write the submission in input order.
    Every row tells whether the loaded state gives the label that the fitted one gave."""
    from eventcraft.operators.evaluate import best_f1
    from eventcraft.operators.split import holdout
    from eventcraft.plans.model import fit_pipeline, positive_score, score_events
    from eventcraft.plans.registry import load_state, save_state
    from eventcraft.sources.csv_io import scratch_path, write_csv
    tr, te = _model_frames(spark, sf)
    h = holdout(tr, "is_new_did", 0.2, 42).checkpoint(eager=True)  # read by fit and scoring
    te = te.checkpoint(eager=True)
    fit_in = h.withColumn("__is_val", F.col("is_valid") == 1)
    m = fit_pipeline(fit_in, features.TREE_MODEL_FEATURES, _trees())
    va = positive_score(m.transform(h.where(F.col("is_valid") == 1)))
    t = best_f1(va, "is_new_did", "score").first()["threshold"]
    path = scratch_path(spark, "state")
    save_state(spark, m, {"features": features.TREE_MODEL_FEATURES, "threshold": t,
                          "inclusive": True}, path)
    m2, cfg = load_state(spark, path)
    fitted = positive_score(m.transform(te), out="__fitted").drop(
        "features", "rawPrediction", "probability", "prediction")
    scored = score_events(m2, fitted, cfg["threshold"], cfg["inclusive"], keep=("__fitted",))
    scored = scored.checkpoint(eager=True)  # read by the sink and the result
    # S5 + J5: the binary submission, rows in input order, header CSV in the shared folder
    write_csv(scored.orderBy("row_id").select("did", "is_new_did"), f"{path}/submission")
    return scored.select("row_id", "did", _in_range().alias("scored"),
                         (F.col("score") == F.col("__fitted")).alias("same_score"),
                         (F.col("is_new_did") == (F.col("score") >= t).cast("int")).alias(
                             "same_rule"))


# --- leaf-wise trees on a label with signal -------------------------------------------------

#: the library's defaults are 3,000 rounds and a patience of 200; the budget holds here too, and
#: the patience is shorter because every round is a handful of jobs
LEAF_PARAMS = {"rounds": 3000, "patience": 5, "learning_rate": 0.5, "leaves": 8, "row_share": 0.8,
               "feature_share": 0.9}


def _planted_frame(spark, sf, k):
    from eventcraft.operators.split import stratified_folds
    tr, _ = _model_frames(spark, sf)
    return stratified_folds(tr.withColumn("planted", planted_label()), "planted", k, 42,
                            keep_rank=False).checkpoint(eager=True)  # bins and blocks read it


def _leaf_bins(df, size=32):
    from eventcraft.operators.boost import fit_bins
    cats = ["channel", "device_brand"]
    return fit_bins(df, [c for c in features.TREE_MODEL_FEATURES if c not in cats], cats, size)


@query("leaf_boost_folds")
def q_leaf_boost_folds(spark, sf):
    """L1 + L2 + L4 + L7: leaf-wise trees on 5 folds grown in the same scans. Per fold: its
    rows and positives, whether the out-of-fold AUC passes 0.78, what ended the fit, whether
    scoring leaves out the rounds without gain, and whether the planted columns (the
    channel, the hour and its part of the day) hold most of the total gain."""
    from eventcraft.operators import boost
    from eventcraft.operators.evaluate import auc
    d = _planted_frame(spark, sf, 5)
    fit = boost.fit_folds(d, _leaf_bins(d), "planted", 5, "row_id", params=boost.Params(**LEAF_PARAMS))
    oof = boost.out_of_fold(fit).checkpoint(eager=True)
    gain = boost.total_gain(boost.node_table(spark, fit)).groupBy(F.col("model").alias("fold")).agg(
        (F.sum(F.when(F.col("feature").isin("channel", "hour", "time_period"), F.col("gain"))) > 0.5 * F.sum(
            "gain")).alias("planted_gain"))
    ended = spark.createDataFrame([(m.fold, m.ended, m.best_round < len(m.trees))
                                   for m in fit.models], "fold int, ended string, cut_back boolean")
    good = auc(oof, "label", "score", ["fold"]).select("fold", (F.col("auc") > 0.78).alias("good_auc"))
    return oof.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias(
        "n_positive")).join(good, "fold").join(ended, "fold").join(gain, "fold")


@query("category_split")
def q_category_split(spark, sf):
    """One split of one category column; which channels it sends to the side of the
    positive label, and their rows. No cut of the channel's number separates the planted set."""
    from eventcraft.operators import boost
    el = _el(spark, sf).select("row_id", "channel", F.col("channel").isin(*PLANTED).cast(
        "int").alias("planted"))
    bins = boost.fit_bins(el, [], ["channel"], 32)
    fit = boost.start(el, bins, "planted", "row_id", [(boost.Params(rounds=1, leaves=2), -1, 0)])
    tree = fit.run()[0].trees[0]
    left_is_high = tree.value[tree.left[0]] > tree.value[tree.right[0]]
    left = [bins.values[0][k - 1] for k in tree.left_bins[0] if 0 < k <= len(bins.values[0])]
    return el.groupBy("channel").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "positive_side", F.col("channel").cast("string").isin(left) == F.lit(left_is_high))


@query("leaf_search")
def q_leaf_search(spark, sf):
    """100 trials on 3 folds in the same scans: trials, scored ones, best ones, whether
    the best passes an AUC of 0.7, and whether the scans stayed within those of one trial
    (a tree of 4 leaves needs at most 3 scans, and each round one more for its scores)."""
    import random
    from eventcraft.operators import boost
    d = _planted_frame(spark, sf, 3).select("row_id", "planted", "fold", "hour", "channel",
                                            "day_of_week", "mid_count", "device_brand")
    rnd = random.Random(42)
    trials = [{"learning_rate": round(10 ** rnd.uniform(-1.5, 0), 4), "min_rows": rnd.randint(1, 50),
               "l2": round(rnd.uniform(0, 5), 3), "leaves": rnd.randint(3, 4)} for _ in range(100)]
    bins = boost.fit_bins(d, ["hour", "day_of_week", "mid_count"], ["channel", "device_brand"], 32)
    rounds = 4
    out, fit = boost.search(d, bins, "planted", 3, "row_id", trials,
                            params=boost.Params(rounds=rounds))
    return out.agg(F.count(F.lit(1)).alias("trials"), F.count_if(_in_range()).alias("scored"),
                   F.count_if("is_best").alias("best"), (F.max("score") > 0.7).alias("good_auc"),
                   F.lit(fit.scans <= 4 * rounds + 1).alias("scans_bounded"))


@query("embed_net")
def q_embed_net(spark, sf):
    """L6 + L7 + P13 + R2: a net with an embedding for every value of its category columns (the
    parameters are a table), on a planted label with turned labels. Per part: its rows,
    whether all are scored, whether the AUC passes 0.75, and whether patience ended the fit."""
    from eventcraft.operators import embednet
    from eventcraft.operators.encode import fit_scaler, scale
    from eventcraft.operators.evaluate import auc
    from eventcraft.operators.split import holdout
    tr, _ = _model_frames(spark, sf)
    cats, nums = ("channel", "hour", "device_brand"), ("mid_count", "ts_span")
    d = holdout(tr.withColumn("planted", planted_label()), "planted", 0.2, 42).select(
        "row_id", "planted", "is_valid", *cats, *nums).checkpoint(eager=True)
    tr, va = d.where("is_valid = 0"), d.where("is_valid = 1")
    stats = fit_scaler(tr, list(nums))
    tr, va = scale(tr, stats), scale(va, stats)
    net = embednet.fit(tr, va, embednet.Settings(cats, nums, rate=0.1, patience=5), "planted", "row_id")
    scored = embednet.score(scale(d, stats), net, "row_id").join(
        d.select("row_id", "planted", "is_valid"), "row_id").checkpoint(eager=True)
    good = auc(scored, "planted", "score", ["is_valid"]).select(
        "is_valid", (F.col("auc") > 0.75).alias("good_auc"))
    return scored.groupBy("is_valid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("planted").alias("n_positive"),
        F.count_if(_in_range()).alias("scored")).join(good, "is_valid").select(
        F.when(F.col("is_valid") == 1, "valid").otherwise("train").alias("part"), "n_rows",
        "n_positive", "scored", "good_auc", F.lit(net.ended).alias("ended"))


@query("sequence_dataset")
def q_sequence_dataset(spark, sf):
    """W4 + W5 + A6 + A7 + E2 + E3 + F11: the sequence model's inputs for the test split,
    every encoder and scaler fitted on the train split only."""
    tr, te = _split(spark, sf)
    out = features.sequence_model_frame(tr, te, with_train=False)["score"]
    from eventcraft.operators.sequence import sequence_text
    return out.select(
        "row_id", sequence_text("seq").alias("seq"),
        *[f"{c}_encoded" for c in features.SEQ_MODEL_CATEGORIES],
        *[F.round(c, 6).alias(c) for c in features.SEQ_MODEL_NUMBERS])
