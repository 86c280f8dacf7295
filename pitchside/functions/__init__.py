"""Column-expression helpers.  Every helper returns a JVM-side ``Column``;
none of them is a Python UDF, so they stay inside whole-stage codegen."""

from pitchside.functions.text import (  # noqa: F401
    alias_exact, alias_regex, code_prefix, infer_group, null_default, strip_ws, title_case,
)
from pitchside.functions.dates import (  # noqa: F401
    date_parts, day_name, month_name, parse_date, weekday0, weekend_flag,
)
from pitchside.functions.numeric import coerce_double, coerce_int, exact_mean  # noqa: F401
from pitchside.functions.labels import (  # noqa: F401
    bin_label, climate_zone, decade, outcome_label, range_bucket, temperature_range_label,
    winner_label,
)
