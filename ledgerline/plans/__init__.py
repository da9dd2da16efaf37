"""Query plans: one function per operator / job, registered with its oracle."""
