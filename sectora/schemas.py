"""Fixed schemas of the engine."""

from pyspark.sql import types as T

# A definition request as sent by a client. Ids are read as text (clients mix numbers and
# strings) and cast at intake.
REQUEST_BODY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("config", T.ArrayType(T.StructType([
        T.StructField("sectionId", T.StringType()),
        T.StructField("attributeIds", T.ArrayType(T.StringType())),
    ]))),
    T.StructField("filters", T.ArrayType(T.StructType([
        T.StructField("sectionId", T.StringType()),
        T.StructField("attributeId", T.StringType()),
        T.StructField("operator", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
    T.StructField("sorts", T.ArrayType(T.StructType([
        T.StructField("sectionId", T.StringType()),
        T.StructField("attributeId", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("sortOrder", T.StringType()),
    ]))),
])
