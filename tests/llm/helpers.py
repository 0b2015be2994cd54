import pandas as pd

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, start=0, extra=False):
    rows = [(i + start, t, "en", "s", len(t) if t else 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # names that operators use themselves
        for c in ("_id", "_text", "fp", "count", "rate", "_n", "_key", "component_id", "_toxic", "length"):
            df = df.withColumn(c, df.doc_id * 0)
    return df


def rows(df):
    return [tuple(r) for r in df.collect()]


def labels(spark, values):
    return spark.createDataFrame(pd.DataFrame(values, columns=["doc_id", "quality", "toxic"]))
