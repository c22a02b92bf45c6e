"""Fixed table schemas (as DDL text), key columns and the values that results depend on."""

from __future__ import annotations

# Header aliases, defaults, key columns, class limits, holidays.
UNIT_ALIASES = {"qty": "units", "quantity": "units", "sales": "units"}
REQUIRED = ["date", "sku_id"]
DEFAULTS = {"store_id": "S01", "price": 0.0, "promo_flag": 0}
SERIES = ["sku_id", "store_id"]
SALES_KEY = ["date", "sku_id", "store_id"]
ABC_LIMITS = (0.8, 0.95)
XYZ_LIMITS = (0.1, 0.25)
HOLIDAYS = [
    "01-01", "01-02", "01-03", "01-04", "01-05", "01-06", "01-07", "01-08",
    "02-23", "03-08", "05-01", "05-09", "06-12", "11-04",
]
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss"]
LAGS = (1, 7, 14)
ROLLING = (7, 28)
MODELS = ["prophet", "xgboost", "lightgbm", "naive", "ens"]
METRICS = ["mae", "rmse", "mape", "smape"]


SALES = (
    "date DATE, sku_id STRING, store_id STRING, category STRING, units DOUBLE, price DOUBLE, promo_flag INT"
)
SALES_HISTORY = (
    "sku_id STRING, date DATE, units DOUBLE, revenue DOUBLE, price DOUBLE, promo_flag INT, created_at TIMESTAMP"
)
SKU_DIM = (
    "sku_id STRING, name STRING, category STRING, store_id STRING, is_active BOOLEAN, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)
FORECAST_RUN = (
    "run_id BIGINT, horizon INT, model_type STRING, status STRING, started_at TIMESTAMP, completed_at TIMESTAMP, "
    "error_message STRING, records_count BIGINT"
)
RUN_RECORD = (
    "run_id BIGINT, at TIMESTAMP, status STRING, horizon INT, model_type STRING, error_message STRING, records_count BIGINT"
)
PREDICTION = (
    "run_id BIGINT, sku_id STRING, date DATE, prophet DOUBLE, xgb DOUBLE, lgbm DOUBLE, ensemble DOUBLE, "
    "p_low DOUBLE, p_high DOUBLE, actual DOUBLE, created_at TIMESTAMP"
)
METRIC = (
    "run_id BIGINT, sku_id STRING, mape_prophet DOUBLE, mape_xgboost DOUBLE, mape_ensemble DOUBLE, "
    "mape_naive DOUBLE, best_model STRING, created_at TIMESTAMP"
)
AUDIT = (
    "id BIGINT, event_type STRING, user_id BIGINT, user_email STRING, ip_address STRING, user_agent STRING, "
    "details STRING, severity STRING, created_at TIMESTAMP"
)
DATASET = (
    "path STRING, name STRING, source_type STRING, row_count BIGINT, column_count INT, columns STRING, "
    "size_bytes BIGINT, status STRING, validation_errors STRING, created_at TIMESTAMP"
)
MODEL_REGISTRY = (
    "model_type STRING, version STRING, file_path STRING, trained_on_rows BIGINT, training_duration_sec DOUBLE, "
    "hyperparameters STRING, metrics STRING, is_active BOOLEAN, created_at TIMESTAMP"
)
FINDING = (
    "severity STRING, category STRING, column_name STRING, message STRING, affected_rows BIGINT, "
    "details MAP<STRING,STRING>"
)
EVALUATION = (
    "sku_id STRING, n_folds INT, "
    + "".join(f"{metric}_{model} DOUBLE, " for model in MODELS for metric in METRICS)
    + "best_model STRING"
)
