"""Fixed table schemas. Zoned instants of the source database are kept as naive UTC."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


CLIENTS = _table(
    Id=IntegerType,
    Longitude=DoubleType,
    Latitude=DoubleType,
    Type=IntegerType,
    Code=StringType,
    PlantGridPower=DoubleType,
    PlantPvPower=DoubleType,
    PlantStorageNominalCap=DoubleType,
    PlantStoragePower=DoubleType,
    plantId=IntegerType,
)

ENERGY = _table(
    TimeStampMeasured=TimestampNTZType,
    ClientId=IntegerType,
    CycleDay=IntegerType,
    CycleMinute=IntegerType,
    BlockNumber=IntegerType,
    PowerToGrid=LongType,
    PowerFromGrid=LongType,
    PowerFromLoad=LongType,
    PowerToPv=LongType,
    PowerFromPv=LongType,
    EnergyToGrid=LongType,
    EnergyFromGrid=LongType,
    EnergyToLoad=LongType,
    EnergyFromLoad=LongType,
    EnergyToStorage=LongType,
    EnergyFromStorage=LongType,
    EnergyToPv=LongType,
    EnergyFromPv=LongType,
    EnergyGridToCounter=LongType,
    EnergyBatteryFromCounter=LongType,
    EnergyPvCounter=LongType,
    StorageSocPercentage=IntegerType,
    StorageSocKwh=DoubleType,
    LoadEnergyCalculated=DoubleType,
)

MEASUREMENTS = _table(
    Time=TimestampNTZType,
    ClientId=IntegerType,
    PowerHEE=DoubleType,
    PowerSetpointHEE=DoubleType,
    PowerGrid=DoubleType,
    PowerPV=DoubleType,
    PowerConsumer=DoubleType,
    SoC=IntegerType,
    SoCKWH=DoubleType,
    Temperature=DoubleType,
    Clouds=IntegerType,
    Visibility=IntegerType,
    Pressure=IntegerType,
    Humidity=IntegerType,
    WindSpeed=DoubleType,
    Weather=StringType,
    WeatherDescription=StringType,
    SunriseDT=TimestampNTZType,
    SunsetDT=TimestampNTZType,
)

WEATHER_FORECAST = _table(
    Time=TimestampNTZType,
    ClientId=IntegerType,
    Temperature=DoubleType,
    Clouds=DoubleType,
    Visibility=DoubleType,
    Humidity=DoubleType,
    Pressure=DoubleType,
    WindSpeed=DoubleType,
    Weather=StringType,
    WeatherDescription=StringType,
    Rain=DoubleType,
)

LOAD_PREDICTIONS = _table(
    Time=TimestampNTZType,
    ClientId=IntegerType,
    LSTMLoadPower=LongType,
    HybridLoadPower=LongType,
    GridPower=LongType,
)

LOAD_PREDICTIONS_1H = _table(
    Time=TimestampNTZType, ClientId=IntegerType, LoadPower=LongType, GridPower=LongType
)

PV_PREDICTIONS = _table(Time=TimestampNTZType, ClientId=IntegerType, PVProductionPower=LongType)

PREDICTIONS = _table(
    Time=TimestampNTZType,
    ClientId=IntegerType,
    GridPrice=DoubleType,
    SoCKWH=DoubleType,
    PowerSetpointHEE=DoubleType,
    MinimumSoC=DoubleType,
    MaximumSoC=DoubleType,
    Mode=IntegerType,
)

TARIFF_SCHEDULES = _table(Id=IntegerType, ScheduleName=StringType, TimeBlocks=StringType)

RUNS = _table(
    ClientId=IntegerType,
    TrainEnd=StringType,
    MAE=DoubleType,
    RMSE=DoubleType,
    SMAPE_percent=DoubleType,
    WMAPE_percent=DoubleType,
    seq_len=IntegerType,
    prediction_steps=IntegerType,
    epochs=IntegerType,
    batch_size=IntegerType,
    n_rows_total=IntegerType,
    n_train_rows=IntegerType,
    n_test_rows=IntegerType,
    n_features=IntegerType,
    training_time_seconds=DoubleType,
    time_per_epoch_seconds=DoubleType,
    was_in_use=BooleanType,
)

TRIALS = StructType([StructField("trials", MapType(StringType(), _table(score=DoubleType)))])

PV_HISTORY_CSV = StructType(
    [
        StructField("date", StringType()),
        StructField("time", StringType()),
        StructField("c23525.pv_power", DoubleType()),
    ]
)
