"""Schemas of the record, leaf, score and report tables."""

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()

ORGANIZATION = T.StructType([
    T.StructField("name", S), T.StructField("address", S),
    T.StructField("website", S), T.StructField("phone_number", S),
])
REGISTRATION = T.StructType([T.StructField("identifier", S), T.StructField("type", S)])
VALUE = T.StructType([T.StructField("value", D), T.StructField("unit", S)])
NUTRIENT = T.StructType([
    T.StructField("nutrient", S), T.StructField("value", D), T.StructField("unit", S),
])
GUARANTEED = T.StructType([
    T.StructField("title", S),
    T.StructField("nutrients", T.ArrayType(NUTRIENT)),
    T.StructField("is_minimal", T.BooleanType()),
])
SPECIFICATION = T.StructType([
    T.StructField("humidity", D), T.StructField("ph", D), T.StructField("solubility", D),
])

# Field order is the record's output order; it fixes leaf positions.
INSPECTION = T.StructType([
    T.StructField("organizations", T.ArrayType(ORGANIZATION)),
    T.StructField("fertiliser_name", S),
    T.StructField("registration_number", T.ArrayType(REGISTRATION)),
    T.StructField("lot_number", S),
    T.StructField("weight", T.ArrayType(VALUE)),
    T.StructField("density", VALUE),
    T.StructField("volume", VALUE),
    T.StructField("npk", S),
    T.StructField("guaranteed_analysis_en", GUARANTEED),
    T.StructField("guaranteed_analysis_fr", GUARANTEED),
    T.StructField("cautions_en", T.ArrayType(S)),
    T.StructField("cautions_fr", T.ArrayType(S)),
    T.StructField("instructions_en", T.ArrayType(S)),
    T.StructField("instructions_fr", T.ArrayType(S)),
    T.StructField("ingredients_en", T.ArrayType(NUTRIENT)),
    T.StructField("ingredients_fr", T.ArrayType(NUTRIENT)),
])

LEAF = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("path", S),
    T.StructField("value", S),
    T.StructField("kind", S),
])
LEAVES = T.ArrayType(LEAF)

ISSUE = T.StructType([T.StructField("loc", S), T.StructField("kind", S)])

# CSV report columns, in the reference's header order.
REPORT_COLUMNS = [
    "Test Case", "Field Name", "Pass/Fail", "Accuracy Score",
    "Pipeline Speed (seconds)", "Expected Value", "Actual Value",
]
REPORT = T.StructType([
    T.StructField("Test Case", T.LongType()),
    T.StructField("Field Name", S),
    T.StructField("Pass/Fail", S),
    T.StructField("Accuracy Score", D),
    T.StructField("Pipeline Speed (seconds)", D),
    T.StructField("Expected Value", S),
    T.StructField("Actual Value", S),
])

MANIFEST = T.StructType([
    T.StructField("doc", S), T.StructField("seq", T.LongType()),
    T.StructField("path", S), T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()),
])
