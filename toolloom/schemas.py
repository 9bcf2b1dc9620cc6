"""Schemas of the tables that flow between operators."""

from __future__ import annotations

# One operation of a spec. Leaves whose JSON type matters are VARIANT, the
# others STRING, so a wrongly typed value survives as its JSON text.
PARAMETER = "STRUCT<`in`: STRING, name: STRING, description: STRING, required: VARIANT, schema: STRUCT<type: VARIANT>>"
OPERATION = (
    "operationId STRING, summary STRING, description STRING, "
    f"parameters ARRAY<{PARAMETER}>, "
    "requestBody STRUCT<content: MAP<STRING, STRING>>"
)

WRAPPED_SPEC = "spec STRUCT<paths: MAP<STRING, STRING>>, mark STRING"
PATH_ITEM = "MAP<STRING, STRING>"

SAMPLE = "instruction STRING, input STRING, output STRING"

GENERATED = "generated STRING, inference_time DOUBLE, num_tokens BIGINT, error STRING, error_message STRING"
