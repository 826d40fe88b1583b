"""Schemas and thresholds shared by every stage."""

from pyspark.sql import types as T

# Acceptance thresholds, label marker and corpus markers.
MIN_USER_CHARS = 5
MAX_USER_CHARS = 8000
MIN_TOOLS = 1
MAX_TOOLS = 32
MAX_MESSAGES = 40
IGNORE_INDEX = -100
CALL_MARKER = "<functioncall>"
END_MARKER = "<|endoftext|>"
CHAT_ROLES = {"USER": "user", "ASSISTANT": "assistant", "FUNCTION RESPONSE": "tool"}

SINGLE_TURN = "single_turn"
MULTI_TURN = "multi_turn"
# Precedence when the same conversation occurs in more than one source.
SOURCE_ORDER = (SINGLE_TURN, MULTI_TURN)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_) for name, type_ in fields.items()])


STRING, LONG, DOUBLE, INTS = T.StringType(), T.LongType(), T.DoubleType(), T.ArrayType(T.IntegerType())
TEXTS = T.ArrayType(STRING)

# Free-form values (parameters, arguments) stay JSON text: their shape differs by row.
TOOL = _struct(type=STRING, function=_struct(name=STRING, description=STRING, parameters=STRING))
CALL = _struct(type=STRING, function=_struct(name=STRING, arguments=STRING))
MESSAGE = _struct(role=STRING, content=STRING, tool_calls=T.ArrayType(CALL))
TURN = _struct(role=STRING, content=STRING)
SEGMENT = _struct(role=STRING, text=STRING, trained=T.BooleanType())
SPAN = _struct(start=T.IntegerType(), len=T.IntegerType())
TOOLS, CALLS, MESSAGES, TURNS, SPANS = (T.ArrayType(t) for t in (TOOL, CALL, MESSAGE, TURN, SPAN))

RAW_SINGLE_TURN = _struct(ord=LONG, query=STRING, tools=STRING, answers=STRING)
RAW_MULTI_TURN = _struct(ord=LONG, system=STRING, chat=STRING)
EXAMPLE = _struct(ord=LONG, source=STRING, tools=TOOLS, messages=MESSAGES)
PACKED = _struct(bin=LONG, input_ids=INTS, labels=INTS, position_ids=INTS, seq_lens=INTS)
EVAL = _struct(input_ids=INTS, labels=INTS, attention_mask=INTS)
STATS = _struct(metric=STRING, value=LONG)
METRICS = _struct(step=LONG, loss=DOUBLE, lr=DOUBLE, elapsed_s=DOUBLE, eval_loss=DOUBLE)
