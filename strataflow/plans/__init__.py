"""The jobs of the warehouse: functions from DataFrames to a DataFrame, without sources or sinks."""
