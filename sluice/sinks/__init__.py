"""sluice.sinks"""
