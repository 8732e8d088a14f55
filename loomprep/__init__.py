"""loomprep: Spark-native operators for building multimodal calibration and
training sample sets (text cleaning, seeded sampling, source mixing, chat
message assembly, length admission, sequence positions, vector gathers and
candidate selection).  Every operator is ``DataFrame -> DataFrame``.
"""

__version__ = "0.1.0"
