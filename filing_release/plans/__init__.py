"""End-to-end plans: the release build and the registered queries."""
