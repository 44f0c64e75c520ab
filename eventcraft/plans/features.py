"""Feature tables of the scripts, built from the operators.

``tree_features``      the boosted-tree table: JSON ids + calendar + device stats
``sequential_features`` adds event rank, first event, time since first
``net_features``        the embedding-net table: cleaned ids as text + user stats
All of them keep ``row_id`` so outputs can be put back in input order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.functions.calendar import add_calendar
from eventcraft.functions.jsonmap import extract_keys, extract_keys_default, extract_keys_int
from eventcraft.operators import device, sequence
from eventcraft.operators.missing import fill_median, fill_mode
from eventcraft.sources.schema import CATEGORY_ID_COLUMNS, DEVICE, TS


def tree_features(events: DataFrame) -> DataFrame:
    """JSON ids with valid flag, calendar columns, device stats joined back (-1 for no id)."""
    df = extract_keys(events, "udmap")
    df = df.withColumns({k: F.coalesce((F.col(k)).try_cast("int"), F.lit(-1))
                         for k in ("botId", "pluginId")})
    df = add_calendar(df).drop("year")
    return device.join_device_stats(df, device.device_stats(df))


def union_tree_features(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Device stats over train and test together, joined onto each (-1 for no id)."""
    stats = device.device_stats_union(train, test)

    def one(df: DataFrame) -> DataFrame:
        d = add_calendar(df).select(*df.columns, "hour", "day_of_week", "is_weekend")
        d = extract_keys_int(d, "udmap")
        return device.join_device_stats(d, stats)
    return one(train), one(test)


def sequential_features(events: DataFrame, key: str = DEVICE) -> DataFrame:
    """Event rank, first timestamp/eid, seconds since first and device first/last stats."""
    ranked = sequence.event_rank(events)
    stats = device.device_first_last(events, key)
    out = ranked.join(stats, key, "left")
    out = out.withColumn("time_since_first",
                         F.coalesce((F.col(TS) - F.col("common_ts_min")) / 1000.0, F.lit(0.0)))
    out = extract_keys_int(out, "udmap")
    return out.withColumn("first_eid", F.coalesce(F.col("first_eid"), F.lit("-1")))


def clean_events(df: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Median-fill ts (M2), mode-fill ids (M3), JSON ids with text defaults (F12, M4),
    the raw JSON column dropped (P1) and ids cast to text (P5)."""
    id_cols = [c for c in (id_cols or CATEGORY_ID_COLUMNS) if c in df.columns]
    d = fill_median(df, [TS]) if TS in df.columns else df
    d = fill_mode(d, id_cols)
    d = extract_keys_default(d, "udmap").drop("udmap")
    return d.withColumns({c: F.col(c).cast("string") for c in id_cols + [DEVICE]})


def net_features(events: DataFrame, with_sequence_feats: bool = True) -> DataFrame:
    """Calendar as text, event rank / first eid / elapsed, user stats with span."""
    d = clean_events(events)
    d = add_calendar(d.withColumn("__ts", F.col(TS).cast("bigint")), "__ts")
    d = d.withColumns({"hour": F.col("hour").cast("string"),
                       "dayofweek": F.col("day_of_week").cast("string"),
                       "month": F.col("month").cast("string"),
                       "year": F.col("year").cast("string")})
    d = d.drop("__ts", "day_of_week", "day_of_month", "time_period", "is_weekend")
    if with_sequence_feats:
        d = sequence.event_rank(d)
        d = sequence.add_first_and_elapsed(d).drop("common_ts_min")
        d = d.withColumn("first_eid", F.coalesce(F.col("first_eid"), F.lit("-1")))
    stats = device.user_stats(d, with_span=with_sequence_feats)
    return d.join(stats, DEVICE, "left")


# Features of the boosted-tree fits. eid-derived columns are left out: in the
# stand-in data the label is a function of eid.
TREE_MODEL_FEATURES = [
    "mid", "device_brand", "ntt", "operator", "common_country", "common_province", "common_city",
    "channel", "os_type", "appver_num", "hour", "day_of_week", "day_of_month", "month",
    "time_period", "is_weekend", "botId", "pluginId", "udmap_is_valid", "mid_count",
    "mid_nunique", "device_brand_nunique", "ts_span",
]


def tree_model_frame(events: DataFrame, fill: float = -1.0) -> DataFrame:
    """Tree features with numeric appver and nulls set to ``fill`` (M4); keeps row_id,
    did, split and the label when present."""
    from eventcraft.functions.mathfn import to_number
    d = tree_features(events).withColumn("appver_num", to_number(F.col("appver")))
    d = d.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fill))
                       for c in TREE_MODEL_FEATURES})
    keep = ["row_id", "did"] + [c for c in ("split", "is_new_did") if c in d.columns]
    return d.select(*keep, *TREE_MODEL_FEATURES)


# The sequence model's category and number columns.
SEQ_MODEL_CATEGORIES = [
    "mid", "did", "device_brand", "ntt", "operator", "common_country", "common_province",
    "common_city", "appver", "channel", "os_type", "botId", "pluginId", "hour", "day_of_week",
]
SEQ_MODEL_NUMBERS = [
    "total_events", "unique_mids", "unique_eids", "ts_span_hours", "avg_events_per_hour",
    "unique_channels", "unique_brands", "hour_diversity", "day_diversity",
]


def sequence_model_frame(train: DataFrame, score: DataFrame | None = None,
                         categories: list[str] | None = None, numbers: list[str] | None = None,
                         seq_len: int = 50, with_train: bool = True) -> dict:
    """The sequence model's inputs for train (and a scoring set), fitted on train only.

    hour / weekday, JSON ids with '0' default (F11); device profile with modal
    mid/eid (A6, A7) joined per device; categories encoded with a ``<UNK>``
    slot (E2); eid encoded with codes from 1 (0 is the pad) and turned into the
    trailing ``seq_len`` sequence (W5 then W4); numbers null -> 0, then scaled
    with train mean / population std (E3); vocabulary sizes (A17).
    Returns ``train`` (unless ``with_train`` is off) and ``score`` frames plus ``vocab``
    and ``sizes``; without ``train`` its rows are only read for the fits.
    """
    from eventcraft.functions.jsonmap import extract_keys_default
    from eventcraft.operators.encode import UNK, encode, fit_scaler, fit_vocab, scale, vocab_sizes
    from eventcraft.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(train.sparkSession)
    cats = categories or SEQ_MODEL_CATEGORIES
    nums = numbers or SEQ_MODEL_NUMBERS

    def prep(df: DataFrame) -> DataFrame:
        d = add_calendar(df).drop("day_of_month", "month", "year", "time_period", "is_weekend")
        d = extract_keys_default(d, "udmap", {"botId": "0", "pluginId": "0"})
        return d.join(device.device_profile(df), DEVICE, "left")

    # the prepared train rows feed three fits: compute them once (reliable checkpoint)
    tr = prep(train).checkpoint(eager=True)
    # one fit for every column; eid's codes are shifted by one so 0 stays the pad
    both = fit_vocab(tr, cats + ["eid"], marker=UNK)
    vocab = both.where(F.col("column") != "eid")
    eid_vocab = both.where(F.col("column") == "eid").withColumn("code", F.col("code") + 1)
    stats = fit_scaler(tr.fillna(0, subset=nums), nums)

    def finish(d: DataFrame) -> DataFrame:
        d = encode(d, vocab, cats, marker=UNK)
        # encoded rows are read three times by the rank (hot list, counts, window)
        d = encode(d, eid_vocab, ["eid"], marker=UNK, suffix="_code").checkpoint(eager=True)
        d = sequence.trailing_sequence(sequence.event_rank(d), "eid_code", pad=0, length=seq_len)
        return scale(d, stats, fill_zero=True)

    out = {"vocab": vocab, "sizes": vocab_sizes(vocab)}
    if with_train:
        out["train"] = finish(tr)
    if score is not None:
        out["score"] = finish(prep(score))
    return out
