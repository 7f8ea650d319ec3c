"""Column expressions shared by all layers."""

from strataflow.functions.clock import (  # noqa: F401
    DAY_FORMAT,
    SECOND_FORMAT,
    day_gap,
    day_of,
    day_of_text,
    from_millis,
    from_seconds,
    millis_of_text,
    processed_at_millis,
    second_text,
)
from strataflow.functions.records import (  # noqa: F401
    decimal_of,
    double_or_zero,
    int_of,
    is_blank,
    snake_case,
    camel_case,
)
from strataflow.functions.words import dictionary_words, distinct_words, register_word_function, word_list  # noqa: F401
