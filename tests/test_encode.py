from lendlens.operators import encode, families


def frame(spark):
    rows = [("a", "Y", "q"), ("b", "N", None), (None, "Y", "r s"), ("a", "N", "t/u"), ("c", "Y", "q"), ("d", "N", "v'w")]
    return spark.createDataFrame(rows, "KIND string, FLAG string, `ODD NAME` string")


def test_null_is_a_category(spark):
    counts = encode.category_counts(frame(spark), ["KIND"])
    assert {(r["value"], r["cnt"]) for r in counts.collect()} == {("a", 2), ("b", 1), ("0", 1), ("c", 1), ("d", 1)}
    profile = encode.category_profile(counts).first()
    assert (profile["n_values"], profile["n_rows"]) == (5, 6)


def test_fit_and_apply(spark):
    df = frame(spark)
    fitted = {e.column: e for e in encode.fit_categories(df)}
    assert fitted["FLAG"].kind == "label" and fitted["FLAG"].values == ("N", "Y")
    assert fitted["KIND"].values == ("a", "0", "b", "c", "d")
    out = encode.apply_categories(df, list(fitted.values()))
    assert out.columns[0] == "FLAG" and "KIND_0" in out.columns and "ODD NAME_t/u" in out.columns
    rows = [r.asDict() for r in out.collect()]
    assert [r["FLAG"] for r in rows] == [1, 0, 1, 0, 1, 0]
    assert [r["KIND_a"] for r in rows] == [1, 0, 0, 1, 0, 0] and [r["KIND_0"] for r in rows] == [0, 0, 1, 0, 0, 0]


def test_quotes_and_backslashes(spark):
    values = ["it's", "a\\b", 'q"q', "`t`"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    out = encode.apply_categories(df, encode.fit_categories(df))
    assert sorted(out.columns) == sorted(f"x_{v}" for v in values)
    assert all(sum(r) == 1 for r in out.collect())


def test_ties_by_value_and_limit(spark):
    df = spark.createDataFrame([(v,) for v in "gfedcba"], "x string")
    assert encode.fit_categories(df)[0].values == ("a", "b", "c", "d", "e")


def test_unseen_value_is_zero(spark):
    fitted = encode.fit_categories(frame(spark))
    new = spark.createDataFrame([("zz", "maybe", "q")], "KIND string, FLAG string, `ODD NAME` string")
    row = encode.apply_categories(new, fitted).first().asDict()
    assert row["FLAG"] == 0 and row["ODD NAME_q"] == 1
    assert sum(v for k, v in row.items() if k.startswith("KIND_")) == 0


def test_table_roundtrip(spark):
    fitted = encode.fit_categories(frame(spark))
    assert sorted(encode.from_table(encode.to_table(spark, fitted)), key=lambda e: e.column) == sorted(
        fitted, key=lambda e: e.column
    )


def test_top_categories_limit_rows_before_the_shuffle(spark):
    plan = encode.top_categories(encode.category_counts(frame(spark), ["KIND"]))
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_families():
    want = {
        "FLAG_DOCUMENT_3": "alternative",
        "EXT_SOURCE_MEAN": "alternative",
        "REG_REGION_NOT_LIVE_REGION": "alternative",
        "OBS_30_CNT_SOCIAL_CIRCLE": "traditional",
        "DAYS_LAST_PHONE_CHANGE": "traditional",
        "PREV_NFLAG_LAST_APPL_IN_DAY_mean": "traditional",
        "CC_SK_DPD_DEF_max": "alternative",
        "ORGANIZATION_TYPE_School": "traditional",
    }
    assert {n: families.family_of(n) for n in want} == want
    sets = families.features_of(["SK_ID_CURR", "TARGET", *want])
    assert len(sets["all"]) == 8 and len(sets["alternative"]) == 4
    assert "alternative" not in families.features_of(["AMT_X"])
    assert families.family_of("AMT_X", alternative=("AMT_",), traditional=()) == "alternative"


def test_catalog(spark):
    rows = families.catalog(spark, ["SK_ID_CURR", "AMT_X", "FLAG_Y"]).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [("AMT_X", "traditional", 0), ("FLAG_Y", "alternative", 1)]


def test_values_that_differ_by_case(spark):
    from lendlens.operators import encode
    from lendlens.operators.scale import fit_scaler, scale_to_array

    rows = [("Red", "x"), ("red", "y"), ("RED", "x"), ("blue", "z"), (None, "x")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, c string, `C_rEd` string")
    fitted = encode.fit_categories(df.drop("id"), ["c"])
    out = encode.apply_categories(df, fitted)
    assert len({n.lower() for n in out.columns}) == len(out.columns)
    made = [n for n in out.columns if n not in ("id", "C_rEd")]
    assert len(made) == 5
    assert all(sum(r[n] for n in made) == 1 for r in out.collect())
    assert scale_to_array(out, fit_scaler(out, made), ["id"]).count() == 5


def test_truth_values_and_dates_are_cleaned(spark):
    from lendlens.operators.clean import clean

    df = spark.sql("SELECT * FROM VALUES (true, DATE'2020-01-02'), (NULL, NULL) AS t(flag, day)")
    assert [tuple(r) for r in clean(df).collect()] == [(1, "2020-01-02"), (0, "0")]
