"""End-to-end flows, the test bed and the registered queries."""
