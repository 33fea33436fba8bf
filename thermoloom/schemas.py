"""Table schemas and the grouping keys shared by the whole package."""

from pyspark.sql import types as T

#: One time series is one place of one source.
SERIES = ("source", "place")

#: Header of an uploaded CSV file, in file order.
RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("room_id/id", T.StringType()),
        T.StructField("noted_date", T.StringType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("out/in", T.StringType()),
    ]
)

#: Uploads lie under ``source=<name>/``; the directory supplies the column.
LANDED = T.StructType([*RAW.fields, T.StructField("source", T.StringType())])

#: Of a scan that is not strict: the text of a record that does not fit the schema.
CORRUPT = T.StructField("corrupt_record", T.StringType())

#: Fitted model, one row per term. ``coef`` is in degrees and multiplies a term
#: of the raw date (see ``operators.forecast``), ``scale`` is the prior scale and
#: ``knot`` the day a trend term starts from.
MODEL = T.StructType(
    [
        T.StructField("ds", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("place", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("coef", T.DoubleType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField("knot", T.DateType()),
    ]
)
