"""DataFrame-to-DataFrame operators; each declares its plan and runs no action."""
