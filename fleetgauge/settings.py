"""Thresholds and value domains.

Fixed values: every number and word below has to equal the rule it stands
for, so they are written out plainly, one line per rule.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: domains ---------------------------------------------------
JOB_TYPES = ("TRAINING", "BATCH_PREDICTION", "PIPELINE_RUN")
STATUSES = ("QUEUED", "RUNNING", "SUCCEEDED", "FAILED", "CANCELLED")
TERMINAL = ("SUCCEEDED", "FAILED")
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
INCIDENT_STATES = ("OPEN", "ACKNOWLEDGED", "RESOLVED")
PERIODS = ("DAILY", "WEEKLY")
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

# --- fixed values: money ------------------------------------------------------
DEFAULT_WEEKLY_BUDGET = 5000.0
UNKNOWN_MACHINE_CPU_RATE = 0.15


@dataclass(frozen=True)
class HealthLimits:
    """Limits of the six health checks."""

    success_1h_min: float = 85.0
    success_1h_high: float = 70.0
    success_24h_min: float = 90.0
    p95_max_seconds: int = 10800
    p95_high_factor: float = 1.5
    overrun_pct: float = 20.0
    budget_critical_pct: float = 150.0
    budget_high_pct: float = 120.0
    stale_minutes: int = 30
    stale_high_minutes: int = 60
    short_job_seconds: int = 300
    gpu_waste_max_pct: float = 30.0


@dataclass(frozen=True)
class DetectorLimits:
    """Limits of the statistical detectors."""

    baseline_days: int = 7
    min_samples: int = 10
    z_flag: float = 3.0
    z_critical: float = 5.0
    top_spikes: int = 20
    fence_factor: float = 2.5
    top_outliers: int = 10
    burst_points: float = 20.0
    burst_critical_points: float = 40.0
    short_job_seconds: int = 300
    waste_flag_pct: float = 20.0


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the rules that look at one event at a time."""

    baseline_seconds: int = 3600
    spike_factor: float = 2.5
    cost_share: float = 0.10
    cost_share_high: float = 0.25
