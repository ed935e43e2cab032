"""Tables, sheets and pages: reading and writing."""
