"""Column expressions without Python in the data path."""

from panelcast.functions.calendar import settlement_period, time_features
from panelcast.functions.numeric import box_cox, inv_box_cox, normal_cdf, normal_quantile, safe_ratio

__all__ = [
    "box_cox",
    "inv_box_cox",
    "normal_cdf",
    "normal_quantile",
    "safe_ratio",
    "settlement_period",
    "time_features",
]
