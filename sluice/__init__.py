"""sluice: audience analytics on Spark — a rule language, audience builder, reports, device-id
clean-up and streaming filters, all expressed as DataFrame operations."""

__version__ = "0.1.0"
