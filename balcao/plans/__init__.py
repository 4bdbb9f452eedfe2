"""Query plans: views, analyst queries, marts, snapshots, forecasts, alerts, jobs."""
