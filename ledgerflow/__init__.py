"""ledgerflow: payment-ledger analytics expressed as Spark DataFrame jobs.

Every operator is a pure function DataFrame(s) -> DataFrame with explicit
the operator inventory and README.md for the layout.
"""

__version__ = "0.1.0"
