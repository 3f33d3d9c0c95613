"""No streaming operators: every source here is a finite snapshot, rebuilt in full per run."""
