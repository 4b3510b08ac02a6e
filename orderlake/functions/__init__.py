"""Column-level helpers built only from ``pyspark.sql.functions``.

Each helper returns a ``Column`` so it stays inside whole-stage codegen.
"""

from orderlake.functions.casts import (  # noqa: F401
    try_string, try_int, try_double, try_bool, parse_ts, finite_or_null, numeric_feature,
    bool_flag, null_flag,
)
from orderlake.functions.codec import (  # noqa: F401
    b64_decode, b64_encode, json_objects, once, utf8_strict, utf8_lenient, sha256_hex,
)
from orderlake.functions.dates import calendar_days, elapsed_days, year_of, month_of  # noqa: F401
