from rankloom.operators.jobs import parse_job_descriptions, split_optional


def profile(spark, *texts):
    jobs = spark.createDataFrame(list(enumerate(texts)), "jd_id long, text string")
    return parse_job_descriptions(jobs).orderBy("jd_id").collect()


def test_parse(spark):
    text = "Requirements:\n- 3+ years of experience\n- Bachelor's degree\n- Python and SQL\nNice to have:\n- Tableau, sql"
    (row,) = profile(spark, text)
    assert (row.required, row.nice, row.min_years, row.min_education) == (["python", "sql"], ["tableau"], 3.0, 2)


def test_lowest_level_and_first_years_count(spark):
    a, b, c = profile(
        spark,
        "Master's or Bachelor's degree. Bonus: PhD, 90 years of experience, 2 years of experience",
        "sql\n  PREFERRED QUALIFICATIONS\nDiploma, 5 years of experience",
        "preferred is not a heading here; nor is nicely put",
    )
    assert (a.min_years, a.min_education) == (90.0, 2)
    assert (b.required, b.min_years, b.min_education) == (["sql"], 5.0, None)
    assert (c.required, c.nice, c.min_years, c.min_education) == ([], [], None, None)


def test_split_at_first_heading(spark):
    texts = ["Bonus points\nexcel", "excel", "a\nGood to have: b\nDesirable c", "a\nnicetohave", "a\nbonuses", "a\n\n Desirable"]
    jobs = spark.createDataFrame(list(enumerate(texts)), "jd_id long, text string")
    rows = split_optional(jobs).orderBy("jd_id").collect()
    assert [(r.required_text, r.optional_text) for r in rows] == [
        ("", "Bonus points\nexcel"),
        ("excel", ""),
        ("a\n", "Good to have: b\nDesirable c"),
        ("a\n", "nicetohave"),
        ("a\nbonuses", ""),
        ("a\n", "\n Desirable"),
    ]
