"""Registered queries: Spark plan + matching oracle SQL per operator."""
