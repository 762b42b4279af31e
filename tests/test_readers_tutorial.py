from pyspark.sql import functions as F

from medallion import fs
from medallion.operators.metrics import count_rows, observed
from medallion.plans.tutorial import harmonise_flat, harmonise_nested, replicate_average, union_sources
from medallion.sources import readers as R


def test_json_array_file_needs_multiline(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/j/a.json", '[{"fields": {"id": 1, "geolocation": [35.9, -78.9]}},\n'
                                          ' {"fields": {"id": 2}}]')
    df = R.read_json(spark, f"{tmp_ws}/j", multi_line=True)
    assert sorted(r.id for r in df.select("fields.id").collect()) == [1, 2]


def test_text_lines_and_whole_files(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/t/a.txt", "x\ny\n")
    assert R.read_text(spark, f"{tmp_ws}/t").count() == 2
    assert [r.value for r in R.read_text(spark, f"{tmp_ws}/t", whole_file=True).collect()] == ["x\ny\n"]


def test_literal_rows_and_counts(spark):
    names = R.literal_rows(spark, [["Jean"], ["Liz"], ["Pierre"], ["Lauric"]], "name string")
    assert count_rows(names) == 4
    df, obs = observed(names, "n", rows=F.count(F.lit(1)), long=F.count_if(F.length("name") > 3))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 4, "long": 3}


def test_replicate_average_modes(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0)], "Year int, `Lower Confidence Limit` double, "
                                                "`Upper Confidence Limit` double")
    full = replicate_average(df, 3)
    assert full.count() == 3 and full.first().avg == 3.0 and "lcl2" in full.columns
    bare = replicate_average(df, 2, keep_derived=False)
    assert bare.columns == ["Year", "lcl", "ucl"] and bare.count() == 2


def test_harmonise_two_shapes(spark):
    wake = spark.createDataFrame([(7, "Bistro", "Restaurant", 1.5, 2.5)],
                                 "HSISID int, NAME string, FACILITYTYPE string, X double, Y double")
    wake = harmonise_flat(wake, "Wake", {"HSISID": "datasetId", "NAME": "name", "FACILITYTYPE": "type",
                                         "X": "geoX", "Y": "geoY"}, state="NC")
    durham = spark.sql("""SELECT named_struct('id', 9L, 'premise_name', 'Cafe', 'premise_state', 'NC',
                           'type_description', '2 - Food Stand', 'geolocation', array(35.9D, -78.9D),
                           'closing_date', '2020-01-01') AS fields, 'x' AS recordid""")
    u = union_sources(wake, harmonise_nested(durham, "Durham"))
    got = {r.county: r for r in u.collect()}
    assert got["Wake"].id == "NC_Wake_7" and got["Wake"].dateEnd is None
    assert got["Durham"].type == "Food Stand" and got["Durham"].dateEnd == "2020-01-01"
    assert got["Durham"].geoY == -78.9 and u.schema["datasetId"].dataType.simpleString() == "bigint"
