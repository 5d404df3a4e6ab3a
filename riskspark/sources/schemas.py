"""Declared schemas of the logical tables."""

from __future__ import annotations

LOAN_PORTFOLIO = """
    AccountNumber long, SnapshotDate date, DisbursedDate date, CurrentAmount decimal(18,2), MOB int,
    RemainingTenor int, IsOpen int, AccountStatus string, DelinquencyStatus string,
    DelinquencyStatusCode int, NumberOfLateStatements int, InvoicedInterest decimal(18,2),
    PaidInterest decimal(18,2), InvoicedFee decimal(18,2), PaidFee decimal(18,2)
"""

LOAN_PORTFOLIO_MONTHLY = """
    AccountNumber long, SnapshotDate date, DisbursedDate date, MOB int, Ever30 int, Ever90 int,
    CurrentAmount decimal(18,2), DelinquencyStatusCode int, AccountStatus string, IsOpen int,
    IsMonthEnd int
"""

APPLICATIONS = """
    ApplicationID long, AccountNumber long, SSN string, IsMainApplicant int, ApplicantNo int,
    HasCoapp int, CoappSameAddress int, ReceivedDate date, DisbursedDate date, BirthDate date,
    Amount decimal(18,2), StartupFee decimal(18,2), InterestRate double, Status string,
    PDScoreNew double, ApplicationScore double, PaymentRemarks int, MaritalStatus string,
    Kronofogden int, Product string, BrokerName string
"""

PAYMENT_FREE_MONTHS = "AccountNumber long, YearMonth int"
FORBEARANCE = "AccountNumber long, ForbearanceName string, StartDate date, EndDate date"

ECL_RESULT = """
    ReportDate date, AccountNumber long, Ord int, RiskStage string, FBE string, SpecialCase string,
    Base decimal(18,2), ECL_SUM decimal(18,2), ECLNPV_SUM decimal(18,2)
"""

CUSTOMER_SCORES = """
    AccountNumber long, SnapshotDate date, MOB int, AppliedApplicationScore double,
    AdjustedBehaviourScore double, PD_Delta double, FBE string, SICR int, Stageing int
"""

CREDIT_EVENTS = "SSN string, EventTypeDesc string, DecisionDate date, InsertDate date"
ID_MAP = "SSN string, ssn_hash string"
OLD_SPECIAL_ACCOUNTS = "AccountNumber long"

BROKER_COMMISSION = """
    BrokerName string, Days int, Months int, CommissionPct double, ChurnDeduction double,
    AmortDeduction double, AmountFrom decimal(18,2), AmountTo decimal(18,2), validTo date,
    validFrom date, FixAmount decimal(18,2), PrevToAmount decimal(18,2), Product string
"""

SCORE_TAPE = "AccountNumber long, P_calibrated double"
ONLINE_COST = "YearMonth int, Cost double"
INVOICES_NOT_PAID = "SnapshotDate date, AccountNumber string, amount double"

MODEL_TAPE = """
    AccountNumber long, SnapshotDate date, MOB int, DisbursedDate date, AccountStatus string,
    Ever90 int, CoappFlag int, TimeSince30 int, TimeSince60 int, Ever30In6Months int,
    Ever30In12Months int, Ever30 int, Ever60In6Months int, Ever60In12Months int, Ever60 int,
    WorstDelinquency6M int, WorstDelinquency12M int, WorstDelinquency int,
    CurrentDelinquencyStatus int, Score double
"""
