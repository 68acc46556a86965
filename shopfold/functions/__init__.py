"""Column -> Column building blocks (all JVM-side, no Python UDF)."""

from shopfold.functions.values import (  # noqa: F401
    first_truthy, is_truthy, to_text, text_of, parse_money, parse_qty, money_of, qty_of,
    vtype, is_number_type,
)
from shopfold.functions.numeric import js_round2, line_total  # noqa: F401
from shopfold.functions.text import (  # noqa: F401
    slugify, table_name_for, format_duration, relative_time, truncate_sample, unmapped_label,
)
