"""Column types of the two tables, as DDL."""

from .. import fixed_values as fixed

# month of the start time; sessions are stored in one folder per month
MONTH = "start_month"
# the load that stored a row; its folders hold nothing else, so a repeated load can take their place
BATCH = "load_batch"


def text_length(declared: str) -> int | None:
    return int(declared[len("varchar(") : -1]) if declared.startswith("varchar") else None


def stored_type(declared: str) -> str:
    """Text lengths are checked when a file is read, so text is stored as plain STRING."""
    return "string" if declared.startswith("varchar") else declared


def _columns(declared: list[tuple[str, str, str]]) -> list[str]:
    return [f"{name} {stored_type(kind)}" for _, name, kind in declared]


SESSION_DDL = ", ".join(["id bigint", *_columns(fixed.SESSION_COLUMNS), "created_at timestamp"])
STATION_DDL = ", ".join([*_columns(fixed.STATION_COLUMNS), "created_at timestamp"])
REJECT_DDL = (
    "for_table string, reject_reason string, file string, block_start bigint, line string, fields string, created_at timestamp"
)
