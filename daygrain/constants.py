"""Names and numbers of the daily weather data model.

Every list in this file is a fixed value: results depend on exactly these entries.
"""

# fixed values: sentinels that stand for a missing measurement
SENTINELS = (-999.0, -9999.0, -99.0)

# fixed values: start of the requested history, and the later start of some parameters
DEFAULT_START = "19810101"
LATE_START = "20010101"
REQUEST_SIZE = 20
LATE_PARAMETERS = (
    "CLRSKY_SFC_PAR_DIRH", "CLRSKY_SFC_PAR_DIFF", "CLRSKY_SFC_LW_UP", "CLRSKY_SFC_LW_DWN",
    "CLRSKY_NKT", "CLRSKY_KT", "CLRSKY_DAYS", "CLOUD_OD", "CLOUD_AMT_NIGHT", "CLOUD_AMT_DAY",
    "CLOUD_AMT", "CDD18_3",
)

# fixed values: columns removed because they are known to be incomplete
INCOMPLETE_COLUMNS = (
    "airmass", "allsky_kt", "allsky_nkt", "allsky_sfc_lw_dwn", "allsky_sfc_lw_up",
    "allsky_sfc_par_diff", "allsky_sfc_par_dirh", "allsky_sfc_par_tot", "allsky_sfc_sw_diff",
    "allsky_sfc_sw_dirh", "allsky_sfc_sw_dni", "allsky_sfc_sw_dwn", "allsky_sfc_sw_up",
    "allsky_sfc_uva", "allsky_sfc_uvb", "allsky_sfc_uv_index", "allsky_srf_alb", "aod_55",
    "aod_55_adj", "aod_84", "gwm_height", "gwm_height_anomaly", "imerg_precliquid_prob",
    "imerg_prectot", "imerg_prectot_count", "midday_insol", "original_allsky_sfc_lw_dwn",
    "original_allsky_sfc_sw_diff", "original_allsky_sfc_sw_dirh", "original_allsky_sfc_sw_dwn",
    "original_clrsky_sfc_lw_dwn", "original_clrsky_sfc_sw_dwn", "psh", "pw", "srf_alb_adj", "sza",
    "toa_sw_dni", "toa_sw_dwn", "ts_adj",
)

# fixed values: columns removed because nearly all their values are zero
ZERO_COLUMNS = ("frost_days", "precsno", "precsnoland", "snodp", "frsno", "frseaice")

# fixed values: measurements the temperature features start from
TEMPERATURE_BASE = (
    "tsoil1", "tsoil2", "tsoil3", "tsoil4",
    "t2m", "t2m_max", "t2m_min", "t10m", "t10m_max", "t10m_min",
    "ts", "ts_min", "ts_max", "tsurf", "t2m_range", "t10m_range", "ts_range",
    "v2m", "v10m", "v50m", "rhoa", "t2mwet",
    "gwettop", "gwetroot", "gwetprof", "evptrns", "et_total", "evland", "z0m", "to3",
    "month",
)

# fixed values: measurements that get rolling statistics in the temperature features
TEMPERATURE_ROLLING = (
    "t2m", "t2m_max", "t2m_min", "t10m", "t10m_max", "t10m_min", "ts", "ts_max", "ts_min", "tsurf",
    "tsoil1", "tsoil2", "tsoil3", "tsoil4", "t2mwet", "rhoa", "gwettop", "gwetroot", "gwetprof",
    "v2m", "v10m", "v50m",
)
TEMPERATURE_LAGS = (1, 2, 3, 4, 5, 6, 7)

# fixed values: measurements, lags and rolling columns of the rain features
RAIN_BASE = (
    "tqv", "qv2m", "qv10m", "rh2m", "t2mdew", "t2mwet", "t2m_range", "t10m_range", "ts_range",
    "ps", "slp", "gwettop", "gwetroot", "gwetprof", "evland", "evptrns", "et_total",
    "u10m", "v10m", "wd10m", "to3", "prectotcorr", "month", "season_num",
)
RAIN_LAGS = (1, 3, 7)
RAIN_ROLLING = ("qv2m", "qv10m", "tqv", "rh2m", "t2mdew", "t2mwet", "ps", "slp", "gwettop", "gwetroot")

ROLLING_WINDOWS = (3, 7)
HORIZON = 7

# fixed values: forecast target prefix and the column it looks ahead on
TARGETS = {"t2m": "t2m", "rain": "prectotcorr", "et": "et_total", "soil": "gwettop", "wind": "ws10m"}

# fixed values: temperature regarded as comfortable, for degree days
COMFORT = 26.0

# fixed values: tolerances (degrees) of the share-within-tolerance metric
TOLERANCES = (0.5, 1.0, 1.5, 2.0)

# fixed values: names under which a scored row may carry its forecast, in order of preference
FORECAST_KEYS = ("forecast", "T2M", "prediction", "value", "y_pred", "output")
