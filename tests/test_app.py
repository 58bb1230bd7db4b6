"""The command line from event files to the final product table."""

import pytest

from tests.conftest import SF, rows_of
from vitrine import app
from vitrine.checks import fixtures as fx
from vitrine.checks.queries import SHOP_SUFFIXES
from vitrine.operators.merge import merge_product_final
from vitrine.operators.pages import extract_product_info
from vitrine.operators.products import build_dim_prd, build_dim_product
from vitrine.sources.files import stream_json_lines
from vitrine.streaming.jobs import start_warehouse_stream


def test_load_extract_merge_twice(spark, lines, tmp_path):
    root, source, pages = (str(tmp_path / n) for n in ("w", "lines", "pages"))
    lines.write.text(source)
    fx.product_pages(spark, SF).write.parquet(pages)
    start_warehouse_stream(stream_json_lines(spark, source), root, f"{root}/_checkpoint", every=None).awaitTermination()

    app.main(["worklist", "--root", root])
    todo = spark.read.parquet(f"{root}/crawl_worklist").count()
    suffixes = [arg for s in SHOP_SUFFIXES for arg in ("--suffix", s)]
    for _ in range(2):
        app.main(["extract", "--root", root, "--pages", pages, *suffixes])
        app.main(["merge", "--root", root])
        app.main(["compact", "--root", root])
    final = spark.read.parquet(f"{root}/dim_product_final")
    expected = merge_product_final(build_dim_product(lines), build_dim_prd(lines),
                                   extract_product_info(fx.product_pages(spark, SF), suffixes=SHOP_SUFFIXES))
    assert rows_of(final) == rows_of(expected) and final.count() > 0
    app.main(["worklist", "--root", root])
    assert spark.read.parquet(f"{root}/crawl_worklist").count() < todo

    app.main(["fact", "--root", root, "--lines", source])
    assert spark.read.parquet(f"{root}/fact_event").count() == lines.count()


def test_arguments():
    args = app.parser().parse_args(["stream", "--root", "r", "--bootstrap", "b:1"])
    assert (args.topic, args.every, args.starting_offsets) == ("product_view", "10 seconds", "latest")
    with pytest.raises(SystemExit):
        app.parser().parse_args(["merge"])
