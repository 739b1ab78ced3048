"""The decision policy: thresholds and switches, validated once, used as literals."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

IDENTIFIER = "IDENTIFIER"
BEHAVIORAL = "BEHAVIORAL"


@dataclass(frozen=True)
class DecisionPolicy:
    """Default values are fixed values of the standard policy."""

    policy_version: str = "1.0.0"
    name_similarity_threshold: float = 0.85
    amount_relative_tolerance: float = 0.10
    wallet_match_enabled: bool = True
    require_type_match: bool = True
    max_step_distance: int = 5
    evidence_mode: str = BEHAVIORAL

    def __post_init__(self) -> None:
        for field in ("name_similarity_threshold", "amount_relative_tolerance"):
            if not 0.0 <= getattr(self, field) <= 1.0:
                raise ValueError(f"{field} must be between 0.0 and 1.0: {getattr(self, field)}")
        if not self.policy_version.strip():
            raise ValueError("policy_version must not be empty")
        if self.max_step_distance < 0:
            raise ValueError(f"max_step_distance must not be negative: {self.max_step_distance}")
        mode = self.evidence_mode.strip().upper()
        if mode not in (IDENTIFIER, BEHAVIORAL):
            raise ValueError(f"unsupported evidence_mode: {self.evidence_mode}")
        object.__setattr__(self, "evidence_mode", mode)

    def with_(self, **changes) -> DecisionPolicy:
        return replace(self, **changes)

    @classmethod
    def from_dict(cls, settings: dict) -> DecisionPolicy:
        """Build from the external setting names; every setting must be there."""
        missing = [name for name in SETTINGS if name not in settings]
        if missing:
            raise ValueError(f"policy settings missing: {', '.join(missing)}")
        values = {}
        for name, (field, kind) in SETTINGS.items():
            value = settings[name]
            # True is an int to Python, and a whole number will do for a fraction.
            fits = isinstance(value, (int, float) if kind is float else kind)
            if not fits or (isinstance(value, bool) and kind is not bool):
                raise ValueError(f"{name} must be of type {kind.__name__}: {value!r}")
            values[field] = kind(value)
        return cls(**values)

    @classmethod
    def from_json(cls, text: str) -> DecisionPolicy:
        return cls.from_dict(json.loads(text))


# External setting name -> (field, type).
SETTINGS = {
    "version": ("policy_version", str),
    "nameSimilarityThreshold": ("name_similarity_threshold", float),
    "amountRelativeTolerance": ("amount_relative_tolerance", float),
    "walletMatchEnabled": ("wallet_match_enabled", bool),
    "requireTypeMatch": ("require_type_match", bool),
    "maxStepDistance": ("max_step_distance", int),
    "evidenceMode": ("evidence_mode", str),
}
