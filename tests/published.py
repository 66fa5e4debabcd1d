"""Published monthly totals with the features and forecasts computed from them (fixed values)."""

# month, orders, customers, units_sold, revenue, average_order_value
MONTHLY_SALES = [
    ("2025-01", 1265, 998, 3958, 621380.65, 491.21),
    ("2025-02", 1251, 1004, 3941, 617859.93, 493.89),
    ("2025-03", 1436, 1113, 4560, 712733.23, 496.33),
    ("2025-04", 1463, 1168, 4588, 682026.66, 466.18),
    ("2025-05", 1566, 1222, 5008, 791172.77, 505.22),
    ("2025-06", 1592, 1281, 5060, 794094.12, 498.8),
    ("2025-07", 1764, 1374, 5704, 925877.7, 524.87),
    ("2025-08", 1769, 1396, 5773, 932142.68, 526.93),
    ("2025-09", 1853, 1447, 5756, 904296.55, 488.02),
    ("2025-10", 1937, 1556, 6153, 938621.1, 484.57),
    ("2025-11", 2012, 1605, 6292, 1005455.83, 499.73),
    ("2025-12", 2063, 1648, 6460, 988995.1, 479.4),
    ("2026-01", 2169, 1713, 6925, 1070652.68, 493.62),
    ("2026-02", 2083, 1646, 6766, 1079235.46, 518.12),
    ("2026-03", 2384, 1857, 7560, 1200439.21, 503.54),
    ("2026-04", 2428, 1891, 7763, 1237153.01, 509.54),
    ("2026-05", 2337, 1850, 7401, 1149116.8, 491.71),
    ("2026-06", 2381, 1875, 7501, 1198879.94, 503.52),
]

# month -> rolling_mean_3, rolling_mean_6, rolling_std_3, revenue_growth_rate, moving_average_difference, seasonal_index
FEATURES = {
    "2025-01": (None, None, None, None, None, 0.7345),
    "2025-03": (None, None, None, -0.005665963367220997, None, 0.7451),
    "2025-04": (650657.9366666666, None, 53787.59521622185, 0.15355146918169613, None, 0.7107),
    "2025-07": (755764.5166666666, 703211.2266666667, 63875.5602777858, 0.0036924299100940705, 52553.28999999992, 1.0),
    "2025-12": (949457.8266666667, 916747.9966666667, 51442.938933985155, 0.07120522860609034, 32709.829999999958, 1.0),
    "2026-06": (1195569.6733333333, 1120932.0433333332, 44219.65466059565, -0.07116032478472487, 74637.63000000012, 1.2031),
}

# month, actual, naive, rolling, linear regression
FORECASTS = [
    ("2026-04-01", 1237153.01, 1200439.21, 1116775.7833333332, 759432.7663878731),
    ("2026-05-01", 1149116.8, 1237153.01, 1172275.8933333333, 783972.3637237593),
    ("2026-06-01", 1198879.94, 1149116.8, 1195569.6733333333, 1224618.7718430923),
]

# model -> MAE, RMSE, MAPE in percent
METRICS = {
    "naive": (58171.05, 62114.54, 4.93),
    "rolling_avg": (48948.86, 70800.14, 4.01),
    "linear_regression": (289534.50, 347471.62, 24.18),
}
