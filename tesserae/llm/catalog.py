"""The queries of this subpackage, and SQL for those that SQL can express."""

from .licenses import OP4_SQL, op4_licenses
from .media import op5_media
from .mixing import OP8_SQL, op8_mixing
from .near_dups import op3_near_dups
from .personal import op9_personal
from .pieces import op6_pieces
from .line_runs import OP10_SQL, op10_line_runs
from .quality_rules import OP2_SQL, op2_quality_rules
from .resampling import op7_resampling
from .substrings import op1_substrings

QUERIES = {
    "op1_substrings": op1_substrings,
    "op2_quality_rules": op2_quality_rules,
    "op3_near_dups": op3_near_dups,
    "op4_licenses": op4_licenses,
    "op5_media": op5_media,
    "op6_pieces": op6_pieces,
    "op7_resampling": op7_resampling,
    "op8_mixing": op8_mixing,
    "op9_personal": op9_personal,
    "op10_line_runs": op10_line_runs,
}

ORACLE_SQL = {
    "op2_quality_rules": OP2_SQL,
    "op4_licenses": OP4_SQL,
    "op8_mixing": OP8_SQL,
    "op10_line_runs": OP10_SQL,
}
