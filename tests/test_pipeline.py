"""Feature pipeline toggles (P13) on the joined hourly panel."""

from gridcast.operators import panel
from gridcast.plans.pipeline import FeatureConfig, PlateauConfig, process
from gridcast.sources import fixtures as fx


def test_toggles_remove_feature_groups(spark, sf001):
    j = panel.panel_join([fx.power_hour(spark, sf001), fx.weather_hour(spark, sf001)])
    off = FeatureConfig(plateau=PlateauConfig(enabled=False), imputation=False, time_features=False,
                        weather_features=False, lag_features=False)
    cols = set(process(j, cfg=off).columns)
    assert not {"hour", "wind_shear_alpha", "is_not_plateau", "production_lag360h"} & cols
    assert {"wind_u_100m", "air_density", "theoretical_power"} <= cols  # physics ignores the toggle (Q18)
    on = FeatureConfig(lags=(24,), roll_shift=24, rolling=((24, 12, "1d"),), delay_days=1)
    out = process(j, cfg=on)
    assert {"hour", "wind_shear_alpha", "production_lag24h", "production_rolling_std_1d"} <= set(out.columns)
    assert out.count() > 0
