from pyspark.sql import functions as F

from regspark.functions import sql


def test_functions_of_sql_are_the_columns(spark):
    given = [None, "", " a  b ", "Água™ de º ²", "İstanbul ﬁ ñ", "1-2,3", " x ", "it's \\ \"q\" 'r'"]
    spark.createDataFrame([(g,) for g in given], "t string").createOrReplaceTempView("given_texts")
    names = sql.register(spark)
    assert sql.register(spark) == names
    got = spark.sql(f"SELECT t, {', '.join(f'{n}(t) AS {n}' for n in names)} FROM given_texts")
    want = spark.table("given_texts").select("t", *(f(F.col("t")).alias(n) for n, (f, _) in sql.FUNCTIONS.items()))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
