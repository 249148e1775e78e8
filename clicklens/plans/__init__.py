"""The reference's jobs as DataFrame -> DataFrame functions (batch and stream)."""
