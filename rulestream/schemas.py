"""Fixed schemas: rule JSON, control messages, block results, alerts.

Events are schema-on-read (``fields MAP<STRING,STRING>``); everything else
has a fixed shape.  Recursive trees (block conditions, rule conditions) are
stored as postfix programs because Spark types cannot recurse.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical behaviour:
# block types, parameter names, condition class names, comparison types,
# composite types, control types, acknowledgement statuses and messages.
# ---------------------------------------------------------------------------
BLOCK_TYPES = ["SINGLE_EVENT", "THRESHOLD", "UNIQUE_THRESHOLD", "SIMPLE_ANOMALY", "DROP_TO_ZERO"]
PARAM_THRESHOLD = "THRESHOLD"
PARAM_UNIQUE_FIELD = "UNIQUE_FIELD"
PARAM_ANOMALY_THRESHOLD = "SIMPLE_ANOMALY_THRESHOLD"
CONDITION_CLASSES = ["EqualCondition", "RegexCondition", "ComparisonCondition", "CompositeCondition"]
RULE_CONDITION_CLASSES = ["AllBlocksOccurredRuleCondition", "AnyBlocksOccurredRuleCondition",
                          "CompositeRuleCondition", "SequenceRuleCondition"]
COMPARISON_TYPES = {"GREATER_THAN": "gt", "GREATER_THAN_OR_EQUAL": "ge",
                    "LESS_THAN": "lt", "LESS_THAN_OR_EQUAL": "le"}
COMPOSITE_TYPES = ["AND", "OR"]
CONTROL_TYPES = ["ADD_RULE", "REMOVE_RULE", "QUERY_STATUS"]
ACK_STATUSES = ["RULE_ACTIVE", "RULE_DEACTIVATED", "ERROR", "STATUS_UPDATE"]
RULE_TYPE_SIMPLE = "SIMPLE"
RULE_TYPE_COMPLEX = "COMPLEX"
TIMESTAMP_FIELD = "@timestamp"
CUSTOMER_FIELD = "customer"
MSG_SINGLE_EVENT = "An event matching the specified conditions was observed."
MSG_THRESHOLD = "Threshold exceeded. %d events were observed in the last %d minutes."
MSG_UNIQUE = "Unique threshold exceeded."
MSG_ANOMALY = "%d matching events seen in %d minutes, up from the average previous average of %d."
MSG_DROP = "0 matching events seen in the last %d seconds."
MSG_VALIDATION_PREFIX = "Control Input failed validation: "
COMPARISON_WINDOW_COUNT = 10       # sub-windows in an anomaly / drop-to-zero comparison window
WATERMARK_DELAY = "10 seconds"     # bounded out-of-orderness of events
OUTPUT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
# ---------------------------------------------------------------------------

# Allowed JSON property names per object kind (unknown property = undecodable).
RULE_KEYS = ["id", "version", "baseSeverity", "blocks", "ruleCondition", "groupByField",
             "windowSize", "windowSlide"]
RULE_NUMBERS = ["version", "baseSeverity", "windowSize", "windowSlide"]
BLOCK_KEYS = ["type", "condition", "windowSize", "windowSlide", "aggregationGroupingFields",
              "parameters"]

# Numbers are read as text so that "1" and 1 both decode (lenient coercion),
# then converted with try_cast.  Nested trees are read as raw JSON text.
BLOCK_JSON = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("condition", T.StringType()),
    T.StructField("windowSize", T.StringType()),
    T.StructField("windowSlide", T.StringType()),
    T.StructField("aggregationGroupingFields", T.ArrayType(T.StringType())),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
])
RULE_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("baseSeverity", T.StringType()),
    T.StructField("groupByField", T.StringType()),
    T.StructField("windowSize", T.StringType()),
    T.StructField("windowSlide", T.StringType()),
    T.StructField("blocks", T.ArrayType(BLOCK_JSON)),
    T.StructField("ruleCondition", T.StringType()),
])

# Postfix program of a block condition.  Leaves push a nullable boolean
# (NULL = evaluation error); 'and'/'or' pop n values and push their fold.
COND_OP = T.StructType([
    T.StructField("op", T.StringType()),      # eq regex gt ge lt le err and or bad
    T.StructField("key", T.StringType()),
    T.StructField("val", T.StringType()),
    T.StructField("num", T.DoubleType()),
    T.StructField("n", T.IntegerType()),
])
COND_PROGRAM = T.ArrayType(COND_OP)

# Postfix program of a rule condition: all/any/seq leaves and and/or nodes.
RULE_OP = T.StructType([
    T.StructField("op", T.StringType()),      # all any seq and or bad
    T.StructField("idx", T.ArrayType(T.IntegerType())),
    T.StructField("neg", T.ArrayType(T.BooleanType())),
    T.StructField("n", T.IntegerType()),
])
RULE_PROGRAM = T.ArrayType(RULE_OP)

CONTROL_JSON = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ruleId", T.StringType()),
    T.StructField("ruleVersion", T.StringType()),
    T.StructField("controlSchemaVersion", T.StringType()),
    T.StructField("content", T.StringType()),
])

SUMMARY = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("sample", T.StringType()),
    T.StructField("count", T.LongType()),
])
SUMMARIES = T.ArrayType(SUMMARY)
