"""Column functions. Each takes and returns ``Column`` and stays native."""

from tidemark.functions.dates import (
    calendar_parts,
    epoch_millis_text,
    epoch_millis_time,
    text_date,
)
from tidemark.functions.money import currency
from tidemark.functions.strings import (
    device_name,
    display_name,
    paid_flag,
    second_part,
    state_code,
    suffix_name,
)
from tidemark.functions.text import (
    clean_text,
    drop_stop_words,
    serving_words,
    split_words,
    training_words,
)

__all__ = [
    "calendar_parts",
    "clean_text",
    "currency",
    "device_name",
    "display_name",
    "drop_stop_words",
    "epoch_millis_text",
    "epoch_millis_time",
    "paid_flag",
    "second_part",
    "serving_words",
    "split_words",
    "state_code",
    "suffix_name",
    "text_date",
    "training_words",
]
