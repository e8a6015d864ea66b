"""rulestream: a dynamic-rules event engine built on Spark DataFrames.

Events (JSON text or any table) are matched against versioned rules whose
blocks count, threshold, compare or watch for silence over event-time
windows; multi-block rules combine block results in sliding rule windows.
Batch runs are plain DataFrame plans; streaming runs use Structured
Streaming with watermarks and ``transformWithState``.
"""

from rulestream.plans.batch import run_rules  # noqa: F401
from rulestream.operators.rules import parse_rules, rules_from_json  # noqa: F401
from rulestream.sources.events import parse_events, table_events  # noqa: F401
from rulestream.operators.control import fold_control  # noqa: F401

__all__ = ["run_rules", "parse_rules", "rules_from_json", "parse_events",
           "table_events", "fold_control"]
