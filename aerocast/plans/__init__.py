"""Models: staging → core (dims, facts) → marts, plus analyses."""
