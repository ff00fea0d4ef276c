"""Plan checks: what reaches the scan, which join strategy, no Python in native operators."""

import pytest

from boxframe.plans import catalog
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_existence_filter_is_a_semi_join_not_an_in_list(spark):
    p = plan(catalog.run(spark, SF_SMALL, "existing_images"))
    assert "LeftSemi" in p
    assert " IN (" not in p.upper().replace("ISNOTNULL", "")


def test_listing_reads_no_file_content(spark):
    p = plan(catalog.run(spark, SF_SMALL, "list_objects"))
    schema = p.split("ReadSchema: ")[1].split(",")[0] if "ReadSchema: " in p else p
    assert "binaryfile" in p.lower()
    assert "content" not in schema and "path" in schema


def test_parquet_scans_are_pruned(spark):
    p = plan(catalog.run(spark, SF_SMALL, "parse_image_list"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


@pytest.mark.parametrize(
    "name",
    ["scale_boxes", "iou_pairs", "counts_one_to_one", "weighted_prf", "map_50_95", "split_exact", "epoch_shuffle",
     "encoded_targets", "transfer_summary"],
)
def test_native_queries_run_no_python(spark, name):
    p = plan(catalog.run(spark, SF_SMALL, name))
    for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF"):
        assert op not in p, (name, op)


def test_pixel_work_is_arrow_batched(spark):
    p = plan(catalog.run(spark, SF_SMALL, "resize_images"))
    assert "MapInPandas" in p and "BatchEvalPython" not in p
