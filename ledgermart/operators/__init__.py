"""DataFrame operators; every one takes column names as parameters."""

from ledgermart.operators.aggregates import (
    distinct_tuples,
    line_balance,
    metrics_row,
    null_scan,
    peer_median,
    pivot_sums,
    sorted_set,
)
from ledgermart.operators.calendar import (
    calendar,
    continuity_breaks,
    coverage,
    derive_from_registry,
    derive_series,
    missing_months,
    month_range,
    month_sequence,
    profile_series,
)
from ledgermart.operators.joins import (
    reconcile,
    selected_rows,
    set_compare,
    set_diff,
    star_join,
    with_membership,
    with_scalar,
)
from ledgermart.operators.measures import (
    MeasureModel,
    account_amount,
    at_last_month,
    macro_value,
    measure_query,
    prior_period,
    share_of_selection,
    trust_card,
)
from ledgermart.operators.population import (
    Population,
    distinct_members_by,
    member_period_state,
    profile_population,
    top_members,
)
from ledgermart.operators.versioning import (
    distributed_row_number,
    latest_by,
    select_version,
    version_ordinal,
)

__all__ = [n for n in dir() if not n.startswith("_")]
