"""Reusable DataFrame operators that the analyses are made of."""

from eventloom.operators.columns import across, drop_complex
from eventloom.operators.compare import frame_difference
from eventloom.operators.materialize import collect_limited, compute
from eventloom.operators.nested import flatten_event_params, flatten_items, flatten_structs, params_for_key
from eventloom.operators.profile import describe_table, distinct_profile, histogram, numeric_summary, profile
from eventloom.operators.quantiles import exact_quantiles
from eventloom.operators.ranking import share_of_total, top_per_group, with_total
from eventloom.operators.rolling import rolling_mean_days, rolling_mean_rows
from eventloom.operators.sessions import number_sessions, session_activity, user_day_sessions
from eventloom.operators.udf_policy import PythonUdfError, apply_policy, udf_report

__all__ = [name for name in dir() if not name.startswith("_")]
