from lakeshift.functions.repair import (  # noqa: F401
    change_timestamp,
    repair_columns,
    repair_zero_date,
    repair_zero_datetime,
    run_timestamp,
    time_text,
    tinyint_to_int,
)
from lakeshift.functions.ddl import schema_ddl  # noqa: F401
