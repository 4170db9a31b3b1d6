"""Declared shape of a labelled table: the only thing the operators know about it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    """Column roles and rules of one table.

    ``required`` fixes the order in which missing columns are reported, ``numeric`` and
    ``allowed`` the order in which bad columns are. A feature is numeric if declared so, or if its
    type is and no allowed values are declared for it; all others are categorical.
    """

    key: str
    target: str
    positive: str
    negative: str
    numeric: tuple[str, ...]
    required: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    probability_name: str = "positive_probability"
    prediction_name: str = "predicted_label"

    def feature_columns(self, columns: Iterable[str]) -> list[str]:
        return [c for c in columns if c not in (self.key, self.target)]

    def _is_numeric(self, name: str, schema: T.StructType) -> bool:
        typed = isinstance(schema[name].dataType, T.NumericType)
        return name in self.numeric or (typed and name not in self.allowed)

    def numeric_features(self, schema: T.StructType, columns: Iterable[str]) -> list[str]:
        return [c for c in self.feature_columns(columns) if self._is_numeric(c, schema)]

    def categorical_features(self, schema: T.StructType, columns: Iterable[str]) -> list[str]:
        return [c for c in self.feature_columns(columns) if not self._is_numeric(c, schema)]


# The customer table's column names, allowed values and score column names.
CUSTOMER_SPEC = DatasetSpec(
    key="customerID",
    target="Churn",
    positive="Yes",
    negative="No",
    required=(
        "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
        "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
        "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
        "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
    ),
    numeric=("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"),
    allowed={
        "gender": ("Female", "Male"),
        "Partner": ("Yes", "No"),
        "Dependents": ("Yes", "No"),
        "PhoneService": ("Yes", "No"),
        "MultipleLines": ("Yes", "No", "No phone service"),
        "InternetService": ("DSL", "Fiber optic", "No"),
        "OnlineSecurity": ("Yes", "No", "No internet service"),
        "OnlineBackup": ("Yes", "No", "No internet service"),
        "DeviceProtection": ("Yes", "No", "No internet service"),
        "TechSupport": ("Yes", "No", "No internet service"),
        "StreamingTV": ("Yes", "No", "No internet service"),
        "StreamingMovies": ("Yes", "No", "No internet service"),
        "Contract": ("Month-to-month", "One year", "Two year"),
        "PaperlessBilling": ("Yes", "No"),
        "PaymentMethod": (
            "Electronic check",
            "Mailed check",
            "Bank transfer (automatic)",
            "Credit card (automatic)",
        ),
        "Churn": ("Yes", "No"),
    },
    probability_name="churn_probability",
    prediction_name="predicted_churn",
)
