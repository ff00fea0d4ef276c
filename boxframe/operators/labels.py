"""Label vocabulary, label encoding and training targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.operators.boxes import MAX_BOXES_PER_ROW, group_annotations
from boxframe.operators.ranking import global_row_number

# Vocabularies up to this many entries are broadcast to the join.
MAX_BROADCAST_LABELS = 1_000_000


def build_vocabulary(df: DataFrame, label_col: str = "LabelName", base: int = 0) -> DataFrame:
    """Distinct labels -> ``LabelName, idx`` (dense, sorted by label, from ``base``).

    Sorted rather than in set order, so ids are the same on every run and
    every worker; ``base=1`` leaves 0 for a background class.
    """
    labels = df.select(F.col(label_col).alias("LabelName")).where(F.col("LabelName").isNotNull()).distinct()
    ranked = global_row_number(labels, ["LabelName"], out="_rn")
    return ranked.select("LabelName", (F.col("_rn") - 1 + F.lit(base)).cast("int").alias("idx"))


def encode_labels(
    df: DataFrame,
    vocab: DataFrame,
    label_col: str = "LabelName",
    out: str = "label",
    max_broadcast: int = MAX_BROADCAST_LABELS,
) -> DataFrame:
    """Look up each label's index (BIGINT); unknown labels get NULL.

    The vocabulary is broadcast only after its row count is checked; pass a
    written or checkpointed vocabulary so the count is cheap.
    """
    v = vocab.select(F.col("LabelName").alias("_lbl"), F.col("idx").cast("bigint").alias(out))
    from boxframe.operators.stats import row_count

    if row_count(v) <= max_broadcast:
        v = F.broadcast(v)
    return df.join(v, df[label_col] == v["_lbl"], "left").drop("_lbl")


def decode_labels(df: DataFrame, vocab: DataFrame, label_col: str = "label", out: str = "LabelName",
                  max_broadcast: int = MAX_BROADCAST_LABELS) -> DataFrame:
    """Turn label indices (as a detector emits them) back into names; unknown indices get NULL.

    ``label_col`` is replaced by ``out``. The vocabulary is broadcast only after its row count is checked.
    """
    from boxframe.operators.stats import row_count

    v = vocab.select(F.col("idx").cast("bigint").alias("_idx"), F.col("LabelName").alias("_name"))
    if row_count(v) <= max_broadcast:
        v = F.broadcast(v)
    kept = [c for c in df.columns if c not in (label_col, out)]
    return df.join(v, df[label_col].cast("bigint") == v["_idx"], "left").select(*kept, F.col("_name").alias(out))


def training_targets(
    valid: DataFrame,
    vocab: DataFrame,
    order_by: str = "box_id",
    key: str = "ImageID",
    max_per_row: int | None = MAX_BOXES_PER_ROW,
) -> DataFrame:
    """Valid long-form boxes -> per image ``boxes ARRAY<ARRAY<FLOAT>>, labels ARRAY<BIGINT>``.

    Boxes and labels are filtered together, so they stay aligned.
    """
    enc = encode_labels(valid, vocab)
    g = group_annotations(
        enc.select(key, order_by, "xmin", "ymin", "xmax", "ymax", "label"),
        ("xmin", "ymin", "xmax", "ymax", "label"),
        order_by=order_by,
        key=key,
        out="_t",
        max_per_row=max_per_row,
    )
    keep = [c for c in g.columns if c != "_t"]
    boxes = F.transform("_t", lambda s: F.array(*[s[c].cast("float") for c in ("xmin", "ymin", "xmax", "ymax")]))
    labels = F.transform("_t", lambda s: s["label"])
    return g.select(*keep, boxes.alias("boxes"), labels.alias("labels"))
