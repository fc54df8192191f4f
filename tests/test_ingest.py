import pandas as pd
import pytest

from clientele.sources import ingest as ing
from clientele.sources import results as res
from clientele.sources.schema import TABLES


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "shop_customers_dataset.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state,extra\n"
        'c1,u1,01037,"sao ""paulo""",SP,x\nc2,u2,00001,NA,RJ,y\n')
    (tmp_path / "shop_products_dataset.csv").write_text(
        "product_id,product_category_name,product_name_lenght,product_photos_qty\n"
        "p1,toys,3.0,abc\np2,,3.7,2\n")
    (tmp_path / "shop_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"first\nline, two",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
        "r2,o2,4,,null,2018-01-01 00:00:00,\nr1,o3,1,,second,2018-02-01 00:00:00,\n")
    return tmp_path


def test_load_all(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    audit = {r.table: r for r in ing.load_all(spark, str(folder), out).collect()}
    assert audit["customers"].rows_written == 2 and audit["orders"].status == "missing"
    assert (audit["order_reviews"].rows_read, audit["order_reviews"].rows_written) == (3, 2)
    assert audit["products"].unparsed_integers == 2
    customers = {r.customer_id: r for r in spark.read.parquet(f"{out}/customers").collect()}
    assert customers["c1"].customer_zip_code_prefix == "01037" and customers["c1"].customer_city == 'sao "paulo"'
    assert customers["c2"].customer_city is None and "extra" not in customers["c1"].asDict()
    reviews = {r.review_id: r for r in spark.read.parquet(f"{out}/order_reviews").collect()}
    assert reviews["r1"].order_id == "o1" and reviews["r1"].review_comment_message == "first\nline, two"
    assert reviews["r2"].review_comment_message is None and reviews["r2"].review_answer_timestamp is None
    products = {r.product_id: r for r in spark.read.parquet(f"{out}/products").collect()}
    assert products["p1"].product_name_length == 3 and products["p1"].product_photos_qty is None
    assert products["p2"].product_name_length is None and products["p2"].product_category_name is None


def test_load_modes(spark, folder, tmp_path):
    out, table = str(tmp_path / "out"), TABLES["customers"]
    path = ing.find_files(spark, str(folder), table)
    for mode, rows in [("append", 2), ("append", 2), ("skip", 2), ("truncate", 2), ("append", 2)]:
        ing.load_table(spark, table, path, out, mode)
        assert spark.read.parquet(f"{out}/customers").count() == rows
    with pytest.raises(ValueError):
        ing.load_table(spark, table, path, out, "other")


def test_a_load_can_be_run_again(spark, folder, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    first = {r.table: r.status for r in ing.load_all(spark, str(folder), out).collect()}
    again = {r.table: r for r in ing.load_all(spark, str(folder), out).collect()}
    assert first["customers"] == "loaded" and again["customers"].status == "already loaded"
    assert spark.read.parquet(f"{out}/customers").count() == 2
    (folder / "more_customers_dataset.csv").write_text("customer_id,customer_unique_id\nc3,u3\n")
    table = TABLES["customers"]
    move = ing._move_in

    def dies(*args, **options):  # after the files are in the table, before the manifest knows them
        move(*args, **options)
        raise OSError("lost")

    monkeypatch.setattr(ing, "_move_in", dies)
    with pytest.raises(OSError):
        ing.load_table(spark, table, ing.find_files(spark, str(folder), table), out)
    monkeypatch.setattr(ing, "_move_in", move)
    status, files = ing.load_table(spark, table, ing.find_files(spark, str(folder), table), out)[1:3]
    assert (status, files) == ("loaded", 1) and spark.read.parquet(f"{out}/customers").count() == 3
    assert ing.loaded_files(spark, f"{out}/customers").count() == 2


def test_playbook_round_trip_and_absence(spark, tmp_path):
    profiles = spark.createDataFrame(
        [(1, "Champions", 3, 60.0, "d", "g", 10, "20%", ["a"], ["k"], 12.5), (2, "Lost", 2, 40.0, "d", "g", 2, "2%", ["b"], ["k"], 1.0)],
        "cohort_id int, cohort_name string, customer_count long, percentage double, description string, marketing_goal string, "
        "priority int, budget_allocation string, recommended_actions array<string>, kpis array<string>, avg_monetary double")
    path = str(tmp_path / "playbook")
    res.write_playbook(res.playbook(profiles, "now"), path)
    rows = {r.cohort_name: r for r in res.read_playbook(spark, path).collect()}
    assert rows["Champions"].actions == ["a"] and rows["Lost"].avg_customer_value == 1.0
    assert res.read_playbook(spark, str(tmp_path / "absent")).count() == 0


def test_feature_list_and_csv(spark, tmp_path):
    res.write_feature_list(spark, ["b", "a"], str(tmp_path / "f"))
    assert res.read_feature_list(spark, str(tmp_path / "f")) == ["b", "a"]
    res.write_csv(spark.createDataFrame([(1, ["x", "y"])], "i int, l array<string>"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True, escape='"').first()["l"] == '["x","y"]'


def test_every_file_of_a_table_is_loaded(spark, folder, tmp_path):
    (folder / "part2_customers_dataset.csv").write_text("customer_id,customer_unique_id\nc3,u3\n")
    (folder / "shop_order_payments_dataset.csv").write_text("order_id,payment_sequential,payment_value\no1,1,12.5\no2,1,much\n")
    out = str(tmp_path / "out")
    audit = {r.table: r for r in ing.load_all(spark, str(folder), out).collect()}
    assert (audit["customers"].files, audit["customers"].rows_written) == (2, 3)
    assert {r.customer_id for r in spark.read.parquet(f"{out}/customers").collect()} == {"c1", "c2", "c3"}
    assert audit["order_payments"].unparsed_decimals == 1 and audit["order_reviews"].unparsed_timestamps == 0


def test_manifest_rows(spark, tmp_path):
    for name, n in (("three", 3), ("none", 0)):
        pd.DataFrame({"id": pd.Series(range(n), dtype="int64")}).to_parquet(tmp_path / f"{name}.parquet")
    found = ing.manifest_rows(spark, str(tmp_path), ["three.parquet", "none.parquet", "absent.parquet"])
    missing = ing.manifest_rows(spark, str(tmp_path), ["absent.parquet"])
    assert [tuple(r) for r in missing.collect()] == [("absent.parquet", "missing", None)]
    assert {tuple(r) for r in found.collect()} == {
        ("three.parquet", "found", 3), ("none.parquet", "found", 0), ("absent.parquet", "missing", None)}
